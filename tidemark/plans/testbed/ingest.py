"""Scans, sinks, watermarks, streams and whole layered runs on the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.incremental import (
    advance_watermark, drop_audit, get_watermark, high_watermark, incremental_scan, next_watermark, pruned_scan, unseen, with_audit,
    with_date_parts,
)
from tidemark.plans.flow import Lakehouse, Mart
from tidemark.plans.testbed.base import BATCH, STAMP, built, query, table
from tidemark.session import work_dir
from tidemark.sources.files import (
    conform_schema, nullable, read_files, stream_files, write_landing, write_partitioned,
)
from tidemark.sources import rescue
from tidemark.sources.inventory import key_offsets, row_counts
from tidemark.sources.tables import LakeTable
from tidemark.spec import ForeignKey, Reject, Rule, TableSpec, columns
from tidemark.streaming.ingest import foreach_batch_sink, load_to_table, stream_to_parquet

SINCE = "2024-01-15 12:00:00"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]
KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey",
    "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id",
    "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id",
}


def _ntz(column: str):
    return F.col(column).cast("timestamp_ntz").alias(column)


# ---- scans and watermarks -----------------------------------------------------------------------------------------

@query("q_incremental_scan", f"SELECT * FROM events WHERE ts > TIMESTAMP '{SINCE}'")
def _incremental_scan(spark, d):
    return incremental_scan(table(spark, d, "events"), "ts", SINCE)


@query("q_late_scan", f"""
SELECT * FROM events WHERE ts > TIMESTAMP '{SINCE}'
UNION ALL
SELECT * FROM events WHERE ts <= TIMESTAMP '{SINCE}' AND ts > TIMESTAMP '{SINCE}' - INTERVAL 3 DAYS AND event_type = 'error'
""")
def _late_scan(spark, d):
    """Errors arrive late: up to the watermark all other events were taken before."""
    events = table(spark, d, "events")
    seen = events.filter((F.col("ts") <= F.lit(SINCE).cast("timestamp_ntz")) & (F.col("event_type") != "error"))
    return unseen(incremental_scan(events, "ts", SINCE, lateness="3 days"), seen, ["event_id"], "ts")


@query("q_pruned_scan", f"""
SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '{SINCE}' - INTERVAL 36 HOURS
""")
def _pruned_scan(spark, d):
    """The same scan of events that are partitioned by the date of their stamp: older partitions are not read."""
    dated = with_date_parts(table(spark, d, "events").select("event_id", "ts", "event_type"), "ts")
    path = work_dir(spark, "dated")
    write_partitioned(dated, path, ["_anio", "_mes", "_dia"])
    held = spark.read.schema(dated.schema).parquet(path)
    return drop_audit(pruned_scan(held, "ts", SINCE, lateness="36 hours"))


@query("q_high_watermark", "SELECT max(ts) AS max_wm FROM events")
def _high_watermark(spark, d):
    return high_watermark(table(spark, d, "events"), "ts").select(_ntz("max_wm"))


@query("q_next_watermark", """
SELECT user_id, max(ts) AS exact, date_trunc('second', max(ts)) + INTERVAL 1 SECOND AS whole_seconds
FROM events GROUP BY user_id
""")
def _next_watermark(spark, d):
    newest = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").cast("timestamp").alias("m"))
    return newest.select(
        "user_id",
        next_watermark(F.col("m")).cast("timestamp_ntz").alias("exact"),
        next_watermark(F.col("m"), "second_plus_one").cast("timestamp_ntz").alias("whole_seconds"),
    )


def event_marks(spark, d) -> DataFrame:
    """Events as entries of a watermark table: the type is the table."""
    return table(spark, d, "events").select(
        F.col("event_type").alias("tabla_nombre"), F.lit("incremental").alias("estrategia"),
        F.col("ts").cast("timestamp").alias("ultimo_proceso"), F.col("ts").cast("timestamp").alias("ultima_ejecucion"),
    )


@query("q_get_watermark", """
SELECT max(ts) AS ultimo_proceso, 'known' AS kind FROM events WHERE event_type = 'view'
UNION ALL SELECT TIMESTAMP '1900-01-01 00:00:00', 'new'
""")
def _get_watermark(spark, d):
    marks = event_marks(spark, d)
    known = get_watermark(marks, "view").withColumn("kind", F.lit("known"))
    both = known.unionByName(get_watermark(marks, "nothing").withColumn("kind", F.lit("new")))
    return both.select(_ntz("ultimo_proceso"), "kind")


@query("q_advance_watermark", f"""
SELECT event_type AS tabla_nombre, 'incremental' AS estrategia,
       CASE WHEN event_type = 'view' THEN TIMESTAMP '{SINCE}' + INTERVAL 1 SECOND ELSE ts END AS ultimo_proceso,
       CASE WHEN event_type = 'view' THEN TIMESTAMP '{STAMP}' ELSE ts END AS ultima_ejecucion
FROM events
""")
def _advance_watermark(spark, d):
    moved = advance_watermark(event_marks(spark, d), "view", f"{SINCE}.750", STAMP, "second_plus_one")
    return moved.select("tabla_nombre", "estrategia", _ntz("ultimo_proceso"), _ntz("ultima_ejecucion"))


# ---- inventories ------------------------------------------------------------------------------------------------

@query("q_key_offsets", " UNION ALL ".join(
    f"SELECT '{t}' AS tabla, CAST(coalesce(max({k}), 0) AS BIGINT) AS max_id FROM {t}" for t, k in KEYS.items()
))
def _key_offsets(spark, d):
    return key_offsets({t: (table(spark, d, t), k) for t, k in KEYS.items()})


@query("q_row_counts", "WITH c AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS tabla, CAST(count(*) AS BIGINT) AS filas FROM {t}" for t in TABLES
) + ") SELECT * FROM c UNION ALL SELECT 'TOTAL', CAST(sum(filas) AS BIGINT) FROM c")
def _row_counts(spark, d):
    return row_counts({t: table(spark, d, t) for t in TABLES})


# ---- conforming, audit columns, files -----------------------------------------------------------------------------

LINE_SCHEMA = "l_orderkey long, l_partkey long, l_linenumber long, l_quantity integer, l_extendedprice double, l_tax double"


@query("q_conform_schema", """
SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END AS l_quantity,
       CAST(l_extendedprice AS DECIMAL(14, 2)) AS l_extendedprice, CAST(l_tax AS DECIMAL(10, 2)) AS l_tax, l_returnflag
FROM lineitem
""")
def _conform_schema(spark, d):
    """Order lines as text, with unreadable quantities, an extra and a rescued column."""
    text = table(spark, d, "lineitem").select(
        *[F.col(c).cast("string").alias(c) for c in ("l_orderkey", "l_partkey", "l_linenumber")],
        F.when(F.col("l_returnflag") == "R", F.lit("n/a"))
        .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(14,2)").cast("string").alias("l_extendedprice"),
        F.col("l_tax").cast("decimal(4,2)").cast("string").alias("l_tax"),
        "l_returnflag",
        F.lit("x").alias("_rescued_data"),
    )
    money = {"l_extendedprice": (14, 2), "l_tax": (10, 2), "l_absent": (10, 2)}
    return conform_schema(text, columns(LINE_SCHEMA + ", l_absent double"), money)


def _bad_lines(spark, d, fmt: str) -> str:
    """A landing folder of order lines, some with values that can't be read and some cut off."""
    line, cents = F.col("l_linenumber"), F.col("l_extendedprice").cast("decimal(14,2)").cast("string")
    fields = [
        F.col("l_orderkey"), line,
        F.when(F.col("l_returnflag") == "R", F.lit("n/a, none")).otherwise(F.col("l_quantity").cast("int").cast("string")).alias("l_quantity"),
        F.when(line == 3, F.translate(cents, ".", ",")).otherwise(cents).alias("l_extendedprice"),
        F.nullif("l_linestatus", F.lit("F")).alias("l_note"),
    ]
    whole = F.to_csv(F.struct(*fields)) if fmt == "csv" else F.to_json(F.struct(*fields))
    cut = F.concat_ws(",", "l_orderkey", F.lit("cut off")) if fmt == "csv" else F.concat(F.lit('{"l_orderkey":'), "l_orderkey", F.lit(","))
    path = work_dir(spark, f"bad-{fmt}")
    table(spark, d, "lineitem").select(F.when(line == 7, cut).otherwise(whole)).write.text(path)
    return path


BAD_SCHEMA = "l_orderkey long!, l_linenumber integer, l_quantity integer, l_extendedprice double, l_note string"
BAD_DECIMALS = {"l_extendedprice": (6, 2)}


def _rejects_sql(fmt: str) -> str:
    cut = "l_orderkey || ',cut off'" if fmt == "csv" else "'{\"l_orderkey\":' || l_orderkey || ','"
    cents = "CAST(CAST(l_extendedprice AS DECIMAL(14, 2)) AS VARCHAR)"
    return f"""
SELECT '{fmt}' AS formato, l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, 'l_quantity' AS columna, 'n/a, none' AS texto,
       'int' AS tipo, 'VALOR_ILEGIBLE: l_quantity' AS motivo_error
FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber <> 7
UNION ALL
SELECT '{fmt}', l_orderkey, CAST(l_linenumber AS INTEGER), 'l_extendedprice', CASE WHEN l_linenumber = 3 THEN replace({cents}, '.', ',') ELSE {cents} END,
       'decimal(6,2)', 'VALOR_ILEGIBLE: l_extendedprice'
FROM lineitem WHERE l_linenumber <> 7 AND (l_linenumber = 3 OR CAST(l_extendedprice AS DECIMAL(14, 2)) >= 10000)
UNION ALL SELECT '{fmt}', NULL, NULL, NULL, {cut}, NULL, 'REGISTRO_ILEGIBLE' FROM lineitem WHERE l_linenumber = 7"""


@query("q_conform_rejects", f"{_rejects_sql('csv')} UNION ALL {_rejects_sql('json')}")
def _conform_rejects(spark, d):
    """Every value that could not be read, with its key, column and text, and every record that wasn't one."""
    out = None
    for fmt in ("csv", "json"):
        text = rescue.read_landing(spark, _bad_lines(spark, d, fmt), fmt, columns(BAD_SCHEMA), {"header": "false"} if fmt == "csv" else None)
        rows = rescue.conform_rescued(text, columns(BAD_SCHEMA), BAD_DECIMALS)
        listed = rescue.rejected_values(rows, ["l_orderkey", "l_linenumber"]).withColumn("formato", F.lit(fmt))
        out = listed if out is None else out.unionByName(listed)
    return out


@query("q_conform_rescued", """
SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END AS l_quantity,
       CASE WHEN l_linenumber <> 3 AND CAST(l_extendedprice AS DECIMAL(14, 2)) < 10000 THEN CAST(l_extendedprice AS DECIMAL(6, 2)) END AS l_extendedprice,
       nullif(l_linestatus, 'F') AS l_note
FROM lineitem WHERE l_linenumber <> 7
""")
def _conform_rescued(spark, d):
    """What could be read of the same lines."""
    text = rescue.read_landing(spark, _bad_lines(spark, d, "json"), "json", columns(BAD_SCHEMA))
    return rescue.readable_rows(rescue.conform_rescued(text, columns(BAD_SCHEMA), BAD_DECIMALS))


BAD_LINES = TableSpec(
    "lines", columns(BAD_SCHEMA), keys=["l_orderkey", "l_linenumber"], date_column="seen", fmt="json", watermark="seen",
    decimals=BAD_DECIMALS, masked=["l_extendedprice"],
)


@query("q_stream_rejects", f"""
SELECT 'lines' AS tabla_origen, motivo_error, l_orderkey, l_linenumber, columna,
       CASE WHEN columna = 'l_quantity' THEN texto END AS texto FROM ({_rejects_sql('json')})
UNION ALL SELECT 'held', '', l_orderkey, CAST(l_linenumber AS INTEGER), NULL, NULL FROM lineitem WHERE l_linenumber <> 7
""")
def _stream_rejects(spark, d):
    """The same lines as a stream into a table, started twice: rows are held once, errors are quarantined once, and no text of a
    masked column is shown."""
    folder, checkpoint, errors = _bad_lines(spark, d, "json"), work_dir(spark, "checkpoint"), work_dir(spark, "errors")
    lake = LakeTable(spark, work_dir(spark, "rescued"))
    for _ in range(2):
        load_to_table(spark, BAD_LINES, folder, lake, checkpoint, now=lambda: datetime(2024, 1, 31), errors=errors)
    found = spark.read.schema("tabla_origen string, motivo_error string, payload string").parquet(errors)
    value = lambda name, kind: F.get_json_object("payload", f"$.{name}").cast(kind).alias(name)
    listed = found.select(
        "tabla_origen", "motivo_error", value("l_orderkey", "bigint"), value("l_linenumber", "int"), value("columna", "string"), value("texto", "string")
    )
    held = lake.read().select(F.lit("held").alias("tabla_origen"), F.lit("").alias("motivo_error"), "l_orderkey", "l_linenumber")
    return listed.unionByName(held, allowMissingColumns=True)


@query("q_audit_parts", f"""
SELECT *, TIMESTAMP '{STAMP}' AS _ingesta_ts, 'orders' AS _fuente, '{BATCH}' AS _lote_id,
       CAST(year(o_orderdate) AS INTEGER) AS _anio, CAST(month(o_orderdate) AS INTEGER) AS _mes,
       CAST(day(o_orderdate) AS INTEGER) AS _dia
FROM orders
""")
def _audit_parts(spark, d):
    out = with_date_parts(with_audit(table(spark, d, "orders"), "orders", BATCH, STAMP), "o_orderdate")
    return out.withColumn("_ingesta_ts", F.col("_ingesta_ts").cast("timestamp_ntz"))


@query("q_drop_audit", "SELECT * FROM orders")
def _drop_audit(spark, d):
    return drop_audit(_audit_parts(spark, d))


def _landed(spark, d, name: str, fmt: str) -> DataFrame:
    source = table(spark, d, name)
    path = work_dir(spark, f"landing-{name}")
    write_landing(source, path, fmt)
    return read_files(spark, path, fmt, source.schema)


@query("q_landing_csv", "SELECT * FROM orders")
def _landing_csv(spark, d):
    return _landed(spark, d, "orders", "csv")


@query("q_landing_json", "SELECT * FROM customer")
def _landing_json(spark, d):
    return _landed(spark, d, "customer", "json")


@query("q_landing_parquet", "SELECT * FROM events")
def _landing_parquet(spark, d):
    return _landed(spark, d, "events", "parquet")


@query("q_write_partitioned", """
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS _anio, CAST(month(o_orderdate) AS INTEGER) AS _mes FROM orders
""")
def _write_partitioned(spark, d):
    """Append by month, then replace the months of the newest orders: only their partitions are written again."""
    path = work_dir(spark, "partitioned")
    dated = with_date_parts(table(spark, d, "orders"), "o_orderdate", ("_anio", "_mes"))
    write_partitioned(dated, path, ["_anio", "_mes"])
    write_partitioned(dated.filter(F.col("_anio") >= 2000), path, ["_anio", "_mes"], "overwrite_partitions")
    return spark.read.schema(dated.schema).parquet(path)


@query("q_append_evolution", """
SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_orderpriority END
       AS o_orderpriority
FROM orders
""")
def _append_evolution(spark, d):
    """The second append brings a new column."""
    lake = LakeTable(spark, work_dir(spark, "append"))
    orders = table(spark, d, "orders")
    base = ["o_orderkey", "o_custkey", "o_totalprice"]
    newer = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    lake.append(orders.filter(~newer).select(*base), datetime(2024, 1, 1))
    lake.append(orders.filter(newer).select(*base, "o_orderpriority"), datetime(2024, 1, 2))
    return lake.read()


@query("q_full_load", "SELECT o_orderkey, o_totalprice FROM orders")
def _full_load(spark, d):
    """An overwrite replaces what was appended before."""
    lake = LakeTable(spark, work_dir(spark, "full"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    lake.append(orders, datetime(2024, 1, 1))
    lake.append(orders, datetime(2024, 1, 2), kind="overwrite")
    return lake.read()


# ---- streams ------------------------------------------------------------------------------------------------------

def _event_stream(spark, d) -> DataFrame:
    schema = table(spark, d, "events").schema
    # As a pattern the path may be a single file as well as a folder of files.
    return stream_files(spark, f"{d}/event[s].parquet", "parquet", nullable(schema))


@query("q_stream_ingest", "SELECT * FROM events")
def _stream_ingest(spark, d):
    """The file sink; started twice, the second time there is nothing new."""
    path, checkpoint = work_dir(spark, "stream"), work_dir(spark, "checkpoint")
    for _ in range(2):
        stream_to_parquet(_event_stream(spark, d), path, checkpoint)
    return spark.read.schema(table(spark, d, "events").schema).parquet(path)


@query("q_stream_foreach_batch", """
SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(10, 2)) AS value FROM events
""")
def _stream_foreach(spark, d):
    """Micro-batches conformed and appended to a table that knows which batches it holds."""
    lake, checkpoint = LakeTable(spark, work_dir(spark, "batches")), work_dir(spark, "checkpoint")
    schema = columns("event_id long, ts timestamp_ntz, user_id long, event_type string, value double")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = conform_schema(batch.drop("props"), schema, {"value": (10, 2)})
        for _ in range(2):  # the second time stands for a replay
            lake.append(rows, datetime(2024, 1, 31), tag=f"batch-{batch_id}", once=True)

    foreach_batch_sink(_event_stream(spark, d), write, checkpoint)
    return lake.read()


# ---- layered runs -------------------------------------------------------------------------------------------------

CUSTOMER = TableSpec(
    name="customer",
    schema=columns("c_custkey long, c_name string, c_nationkey integer, c_acctbal double, c_mktsegment string"),
    keys=["c_custkey"],
    date_column="seen",
    watermark="seen",
    rejects=[Reject("SALDO_NEGATIVO", lambda: F.col("c_acctbal") < 0)],
    rules=[Rule("key", lambda: F.col("c_custkey").isNotNull(), True)],
)
ORDERS = TableSpec(
    name="orders",
    schema=columns("o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"),
    keys=["o_orderkey"],
    date_column="o_orderdate",
    date_parts=("_anio", "_mes"),
    watermark="o_orderdate",
    nulls={"o_orderpriority": ("imputar", "NONE"), "o_orderstatus": ("indicador", None)},
    masked=["o_totalprice"],
    derive=lambda df, as_of: df.withColumn("big", F.when(F.col("o_totalprice") > 250000, 1).otherwise(0)),
    rejects=[Reject("PRECIO_BAJO", lambda: F.col("o_totalprice") < 20000)],
    parents=[ForeignKey("o_custkey", "customer", "c_custkey")],
    rules=[Rule("price", lambda: F.col("o_totalprice") >= 20000, True)],
)
ORDER_FACT = Mart(
    "fact_orders", ["o_orderkey"], ["o_orderstatus"],
    lambda t, run: t["orders"]
    .select("o_orderkey", "o_custkey", "o_orderstatus", "big", F.year("o_orderdate").alias("anio"), F.month("o_orderdate").alias("mes"))
    .join(t["customer"].select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left")
    .drop("c_custkey"),
    "orders", "o_orderkey", dims={"customer": ("o_custkey", "c_custkey")},
)


def two_runs(spark, d) -> Lakehouse:
    return built(spark, d, "two runs", _two_runs)


def _two_runs(spark, d) -> Lakehouse:
    """A lakehouse fed twice: with the orders of a first period, then with all of them (the old ones are skipped)."""
    lake = Lakehouse(spark, work_dir(spark, "lakehouse"), [CUSTOMER, ORDERS], [ORDER_FACT])
    customer = table(spark, d, "customer").withColumn("seen", F.lit("1994-01-01").cast("timestamp_ntz"))
    orders = table(spark, d, "orders")
    early = orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    lake.run({"customer": customer, "orders": early}, datetime(2024, 1, 1))
    lake.run({"customer": customer, "orders": orders}, datetime(2024, 1, 2))
    return lake


GOOD_SQL = """
good AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, CAST(o_totalprice > 250000 AS INTEGER) AS big
  FROM orders WHERE o_totalprice >= 20000 AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
)"""


@query("q_two_run_clean", f"""
WITH {GOOD_SQL}
SELECT *, CAST(NULL AS DOUBLE) AS o_totalprice, 1 AS _o_totalprice_enmascarado, 0 AS _nulo_o_orderstatus,
       CAST(year(o_orderdate) AS INTEGER) AS _anio, CAST(month(o_orderdate) AS INTEGER) AS _mes
FROM good
""")
def _two_run_clean(spark, d):
    return two_runs(spark, d).silver("orders").read().drop("_silver_ts", "_silver_lote")


@query("q_two_run_fact", f"""
WITH {GOOD_SQL}
SELECT o_orderkey, o_custkey, o_orderstatus, big, CAST(year(o_orderdate) AS INTEGER) AS anio,
       CAST(month(o_orderdate) AS INTEGER) AS mes, c_mktsegment
FROM good JOIN customer ON o_custkey = c_custkey
""")
def _two_run_fact(spark, d):
    return two_runs(spark, d).gold("fact_orders").read().drop("_gold_ts", "_gold_lote")


@query("q_two_run_errors", """
SELECT 'orders' AS tabla_origen,
       CASE WHEN o_totalprice < 20000 THEN 'PRECIO_BAJO' ELSE 'FK_INVALIDA: o_custkey no existe en customer' END AS motivo_error,
       o_orderkey AS k
FROM orders WHERE o_totalprice < 20000 OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT 'customer', 'SALDO_NEGATIVO', c_custkey FROM customer WHERE c_acctbal < 0
""")
def _two_run_errors(spark, d):
    key = F.coalesce(F.get_json_object("payload", "$.o_orderkey"), F.get_json_object("payload", "$.c_custkey"))
    return two_runs(spark, d).errors().select("tabla_origen", "motivo_error", key.cast("bigint").alias("k"))


@query("q_run_log", """
SELECT 'bronze' AS capa, 'customer' AS tabla, 1 AS run, CAST(count(*) AS BIGINT) AS registros_procesados,
       'EXITOSO' AS estado FROM customer
UNION ALL SELECT 'bronze', 'orders', 1, count(*), 'EXITOSO' FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
UNION ALL SELECT 'bronze', 'customer', 2, 0, 'SIN_CAMBIOS'
UNION ALL SELECT 'bronze', 'orders', 2, count(*), 'EXITOSO' FROM orders
  WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')
""")
def _run_log(spark, d):
    log = two_runs(spark, d).run_log().filter(F.col("capa") == "bronze")
    run = F.dayofmonth("ts_ejecucion").alias("run")
    return log.select("capa", "tabla", run, "registros_procesados", "estado")


