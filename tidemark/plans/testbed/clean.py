"""Cleaning and quality operators on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.cleaning import (
    apply_null_strategies, dedup, duplicate_rejects, exclude_nulls, fill_nulls, fk_orphans, fk_split, fk_valid,
    mask_null, null_flags, null_out_invalid, quarantine, split_by_rule,
)
from tidemark.operators.quality import Watched, null_profile, quality_report, quality_rules
from tidemark.plans.testbed.base import BATCH, STAMP, query, table
from tidemark.session import work_dir
from tidemark.spec import Rule

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = """ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                         l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"""


@query("q_dedup_latest", f"""
SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber {LINE_ORDER}) AS r
                           FROM lineitem) WHERE r = 1
""")
def _dedup(spark, d):
    return dedup(table(spark, d, "lineitem"), LINE_KEY, ["l_shipdate"])


@query("q_dedup_rejects", f"""
SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber {LINE_ORDER}) AS r
                           FROM lineitem) WHERE r > 1
""")
def _dedup_rejects(spark, d):
    return duplicate_rejects(table(spark, d, "lineitem"), LINE_KEY, ["l_shipdate"])


@query("q_dedup_copies", """
SELECT lang, source, n_chars, text FROM
  (SELECT *, row_number() OVER (PARTITION BY lang, source, n_chars, text ORDER BY doc_id) AS r FROM documents)
WHERE r > 1
""")
def _dedup_copies(spark, d):
    """Exact copies only: every column is part of the key."""
    docs = table(spark, d, "documents").select("lang", "source", "n_chars", "text")
    return duplicate_rejects(docs, docs.columns)


def lines_with_nulls(spark, d):
    """Order lines in which some values are missing."""
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.nullif("l_discount", F.lit(0.0)).alias("disc"),
        F.nullif("l_returnflag", F.lit("R")).alias("flag"),
        F.nullif("l_linenumber", F.lit(7)).alias("num"),
    )


NULLED_SQL = """
nulled AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0.0) AS disc, nullif(l_returnflag, 'R') AS flag,
                  nullif(l_linenumber, 7) AS num FROM lineitem)"""


@query("q_null_impute", f"""
WITH {NULLED_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(disc, 0.01) AS disc, coalesce(flag, 'none') AS flag, num FROM nulled
""")
def _null_impute(spark, d):
    return fill_nulls(lines_with_nulls(spark, d), {"disc": 0.01, "flag": "none", "num": "text", "absent": 1})


@query("q_null_exclude", f"WITH {NULLED_SQL} SELECT * FROM nulled WHERE disc IS NOT NULL AND flag IS NOT NULL")
def _null_exclude(spark, d):
    return exclude_nulls(lines_with_nulls(spark, d), ["disc", "flag", "absent"])[0]


@query("q_null_indicator", f"""
WITH {NULLED_SQL}
SELECT *, CAST(disc IS NULL AS INTEGER) AS _nulo_disc, CAST(flag IS NULL AS INTEGER) AS _nulo_flag FROM nulled
""")
def _null_indicator(spark, d):
    return null_flags(lines_with_nulls(spark, d), ["disc", "flag", "absent"])


@query("q_null_strategies", f"""
WITH {NULLED_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, disc, coalesce(flag, 'none') AS flag, num,
       CAST(disc IS NULL AS INTEGER) AS _nulo_disc, 0 AS _nulo_flag
FROM nulled WHERE num IS NOT NULL
""")
def _null_strategies(spark, d):
    strategies = {
        "disc": ("indicador", None), "flag": ("imputar", "none"), "num": ("excluir", None), "absent": ("excluir", None),
    }
    kept, _ = apply_null_strategies(lines_with_nulls(spark, d), strategies)
    return null_flags(kept, ["flag"])


@query("q_null_excluded_rejects", f"WITH {NULLED_SQL} SELECT * FROM nulled WHERE num IS NULL")
def _null_excluded(spark, d):
    return apply_null_strategies(lines_with_nulls(spark, d), {"num": ("excluir", None)})[1]


@query("q_mask_null", """
SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment, 1 AS _c_acctbal_enmascarado
FROM customer
""")
def _mask(spark, d):
    return mask_null(table(spark, d, "customer"), ["c_acctbal", "absent"])


def good_customers(spark, d):
    return table(spark, d, "customer").filter(F.col("c_acctbal") > 0).select("c_custkey")


@query("q_fk_orphans", """
SELECT *, 'FK_INVALIDA: o_custkey no existe en customer' AS motivo_error FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def _fk_orphans(spark, d):
    return fk_orphans(table(spark, d, "orders"), good_customers(spark, d), "o_custkey", "c_custkey", "customer")


@query("q_fk_valid", """
SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def _fk_valid(spark, d):
    # Parents given several times must not multiply rows.
    repeated = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    parents = good_customers(spark, d).join(repeated, "c_custkey").unionByName(good_customers(spark, d))
    return fk_valid(table(spark, d, "orders"), parents, "o_custkey", "c_custkey")


@query("q_fk_split", """
SELECT *, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS known FROM orders
""")
def _fk_split(spark, d):
    good, bad = fk_split(table(spark, d, "orders"), good_customers(spark, d), "o_custkey", "c_custkey")
    return good.withColumn("known", F.lit(True)).unionByName(bad.withColumn("known", F.lit(False)))


@query("q_quarantine", f"""
SELECT 'customer' AS tabla_origen, 'SALDO_NEGATIVO' AS motivo_error, TIMESTAMP '{STAMP}' AS ts_error,
       '{{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
       || ',"c_mktsegment":"' || c_mktsegment || '"}}' AS payload
FROM customer WHERE c_acctbal < 0
""")
def _quarantine(spark, d):
    _, bad = split_by_rule(table(spark, d, "customer"), F.col("c_acctbal") < 0, "SALDO_NEGATIVO")
    rows = quarantine(bad.drop("c_acctbal"), "customer", STAMP)
    return rows.withColumn("ts_error", F.col("ts_error").cast("timestamp_ntz"))


@query("q_split_good", "SELECT * FROM customer WHERE c_acctbal >= 0")
def _split_good(spark, d):
    return split_by_rule(table(spark, d, "customer"), F.col("c_acctbal") < 0)[0]


@query("q_split_bad", "SELECT *, 'SALDO_NEGATIVO' AS motivo_error FROM customer WHERE c_acctbal < 0")
def _split_bad(spark, d):
    return split_by_rule(table(spark, d, "customer"), F.col("c_acctbal") < 0, "SALDO_NEGATIVO")[1]


@query("q_null_out", """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
""")
def _null_out(spark, d):
    return null_out_invalid(table(spark, d, "customer"), "c_acctbal", F.col("c_acctbal") < 0)[0]


ORDER_RULES = [
    Rule("key", lambda: F.col("o_orderkey").isNotNull(), True),
    Rule("status", lambda: F.col("o_orderstatus").isin("F", "O")),
    Rule("price between", lambda: F.col("o_totalprice").between(5000, 400000), True),
    Rule("priority length", lambda: F.length("o_orderpriority") == 6),
    Rule("null passes", lambda: F.nullif("o_orderstatus", F.lit("P")) == "F"),
    Rule("broken", lambda: F.col("no_such_column") > 0, True),
    Rule("fails while running", lambda: F.coalesce(F.col("o_orderpriority").cast("int"), F.raise_error(F.lit("no number"))) > 0),
]


@query("q_quality_rules", """
WITH t AS (SELECT count(*) AS n FROM orders),
f AS (
  SELECT 'key' AS prueba, CAST(count(*) FILTER (o_orderkey IS NULL) AS BIGINT) AS n_fallos, TRUE AS critica FROM orders
  UNION ALL SELECT 'status', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')), FALSE FROM orders
  UNION ALL SELECT 'price between', count(*) FILTER (NOT o_totalprice BETWEEN 5000 AND 400000), TRUE FROM orders
  UNION ALL SELECT 'priority length', count(*) FILTER (length(o_orderpriority) <> 6), FALSE FROM orders
  UNION ALL SELECT 'null passes', count(*) FILTER (o_orderstatus = 'O'), FALSE FROM orders
)
SELECT 'orders' AS tabla, prueba, n_fallos = 0 AS aprobada, n_fallos, round(n_fallos / n * 100, 2) AS pct_fallo, critica,
       CASE WHEN n_fallos = 0 THEN 'APROBADA' WHEN critica THEN 'FALLIDA' ELSE 'ADVERTENCIA' END AS estado
FROM f, t
UNION ALL SELECT 'orders', 'broken', FALSE, 0, 0.0, TRUE, 'ERROR'
UNION ALL SELECT 'orders', 'fails while running', FALSE, 0, 0.0, FALSE, 'ERROR'
""")
def _quality_rules(spark, d):
    return quality_rules(table(spark, d, "orders"), "orders", ORDER_RULES).drop("ts_ejecucion")


@query("q_null_profile", f"""
WITH {NULLED_SQL}
SELECT 'l_orderkey' AS columna, CAST(count(*) FILTER (l_orderkey IS NULL) AS BIGINT) AS n_nulos,
       round(count(*) FILTER (l_orderkey IS NULL) / count(*) * 100, 2) AS pct_nulos FROM nulled
UNION ALL SELECT 'l_linenumber', count(*) FILTER (l_linenumber IS NULL), 0.0 FROM nulled
UNION ALL SELECT 'l_partkey', count(*) FILTER (l_partkey IS NULL), 0.0 FROM nulled
UNION ALL SELECT 'disc', count(*) FILTER (disc IS NULL), round(count(*) FILTER (disc IS NULL) / count(*) * 100, 2)
  FROM nulled
UNION ALL SELECT 'flag', count(*) FILTER (flag IS NULL), round(count(*) FILTER (flag IS NULL) / count(*) * 100, 2)
  FROM nulled
UNION ALL SELECT 'num', count(*) FILTER (num IS NULL), round(count(*) FILTER (num IS NULL) / count(*) * 100, 2)
  FROM nulled
""")
def _null_profile(spark, d):
    return null_profile(lines_with_nulls(spark, d))


@query("q_quality_report", f"""
WITH {NULLED_SQL}, kept AS (SELECT flag, num FROM nulled WHERE disc IS NOT NULL)
SELECT 'lineitem' AS tabla, '{BATCH}' AS lote_id, (SELECT CAST(count(*) AS BIGINT) FROM nulled) AS n_registros_bronze,
       CAST(count(*) AS BIGINT) AS n_registros_silver, (SELECT CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) FROM nulled) AS n_duplicados,
       (SELECT CAST(count(*) AS BIGINT) FROM nulled WHERE disc IS NULL) AS n_rechazados,
       round(count(*) / (SELECT count(*) FROM nulled) * 100, 2) AS pct_conformes,
       '{{"flag":' || round(count(*) FILTER (flag IS NULL) / count(*) * 100, 2) || ',"num":'
       || round(count(*) FILTER (num IS NULL) / count(*) * 100, 2) || '}}' AS detalle_nulos
FROM kept
""")
def _quality_report(spark, d):
    before = lines_with_nulls(spark, d)
    after, rejected = exclude_nulls(before, ["disc"])
    repeated = before.count() - dedup(before, LINE_KEY).count()
    return quality_report(before, after.select("flag", "num"), "lineitem", BATCH, STAMP, repeated, rejected.count()).drop("ts_reporte")


@query("q_observed_report", """
WITH g AS (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders WHERE o_totalprice >= 20000),
t AS (SELECT count(*) AS n FROM g),
f AS (
  SELECT 'key' AS prueba, CAST(count(*) FILTER (o_orderkey IS NULL) AS BIGINT) AS n_fallos, TRUE AS critica FROM g
  UNION ALL SELECT 'status', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')), FALSE FROM g
  UNION ALL SELECT 'price between', count(*) FILTER (NOT o_totalprice BETWEEN 5000 AND 400000), TRUE FROM g
  UNION ALL SELECT 'priority length', count(*) FILTER (length(o_orderpriority) <> 6), FALSE FROM g
  UNION ALL SELECT 'null passes', count(*) FILTER (o_orderstatus = 'O'), FALSE FROM g
)
SELECT prueba AS what, n_fallos AS n, round(n_fallos / n * 100, 2) AS pct,
       CASE WHEN n_fallos = 0 THEN 'APROBADA' WHEN critica THEN 'FALLIDA' ELSE 'ADVERTENCIA' END AS text FROM f, t
UNION ALL SELECT 'broken', 0, 0.0, 'ERROR'
UNION ALL SELECT 'report', n, round(n / (SELECT count(*) FROM orders) * 100, 2),
  '{"o_orderkey":0.0,"o_totalprice":0.0,"status":' || round((SELECT count(*) FILTER (status IS NULL) FROM g) / n * 100, 2) || '}' FROM t
UNION ALL SELECT 'rejected', count(*), NULL, NULL FROM orders WHERE o_totalprice < 20000
UNION ALL SELECT 'written', count(*), NULL, NULL FROM orders
""")
def _observed_report(spark, d):
    """Counts, rules and report of the good rows, taken while all rows are written."""
    orders = table(spark, d, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    bad = F.col("o_totalprice") < 20000
    watched = Watched(orders, "orders", ORDER_RULES[:6], ~bad, ["o_orderkey", "o_totalprice", "status"], bad=F.count_if(bad))
    path = work_dir(spark, "observed")
    watched.frame.write.parquet(path)
    written = spark.read.schema(orders.schema).parquet(path)
    pct = lambda c: F.col(c).cast("double").alias("pct")
    rules = watched.verdicts().select(F.col("prueba").alias("what"), F.col("n_fallos").alias("n"), pct("pct_fallo"), F.col("estado").alias("text"))
    report = watched.report(BATCH, STAMP, watched.count("bad") + watched.count("_n"), 0, watched.count("bad"))
    line = report.select(F.lit("report").alias("what"), F.col("n_registros_silver").alias("n"), pct("pct_conformes"), F.col("detalle_nulos").alias("text"))
    rejected = report.select(F.lit("rejected").alias("what"), F.col("n_rechazados").alias("n"))
    counted = written.agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("written"))
    return rules.unionByName(line).unionByName(rejected, True).unionByName(counted, True)
