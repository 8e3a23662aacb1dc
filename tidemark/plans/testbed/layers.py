"""Whole lakehouses on the test tables: late and tied rows, changed dimensions, rebuilt marts, KPI tables, failing steps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.incremental import init_watermarks
from tidemark.operators.rollup import AGAIN, Rollup
from tidemark.plans import marts
from tidemark.plans.flow import Kpi, Lakehouse, Mart, Watch
from tidemark.plans.testbed.base import STAMP, built, query, table
from tidemark.session import work_dir
from tidemark.sources.files import nullable, read_files, stamp_modified, stream_files, write_landing
from tidemark.spec import ForeignKey, TableSpec, columns
from tidemark.streaming.ingest import load_all, stream_to_parquet
from tidemark.streaming.late import load_on_time, on_time, too_late

DAYS = [datetime(2024, 1, d) for d in (1, 2, 3)]


def _seen(df, day: int):
    return df.withColumn("seen", F.lit(f"1994-01-0{day} 00:00:00").cast("timestamp"))


PRICES = TableSpec(
    "prices", columns("o_orderkey long, o_totalprice double"), keys=["o_orderkey"], date_column="seen", watermark="seen",
    lateness="30 days",
)


# ---- ties, missing stamps and late rows -------------------------------------------------------------------------------

@query("q_ties_at_watermark", """
SELECT o_orderkey AS k, 'taken' AS what FROM orders WHERE o_orderkey % 50 <> 0
UNION ALL SELECT o_orderkey, 'SIN_FECHA: month' FROM orders WHERE o_orderkey % 50 = 0
""")
def _ties(spark, d):
    """Stamps of whole months: half of the border month's rows arrive a load later, and some rows have no stamp at all."""
    spec = TableSpec("months", columns("o_orderkey long"), keys=["o_orderkey"], date_column="month", watermark="month")
    lake = Lakehouse(spark, work_dir(spark, "ties"), [spec])
    month = F.when(F.col("o_orderkey") % 50 != 0, F.date_trunc("month", F.col("o_orderdate")).cast("timestamp"))
    rows = table(spark, d, "orders").select("o_orderkey", month.alias("month"))
    border = F.lit("1996-06-01").cast("timestamp")
    lake.run({"months": rows.filter((F.col("month") < border) | ((F.col("month") == border) & (F.col("o_orderkey") % 2 == 0)))}, DAYS[0])
    for day in DAYS[1:]:
        lake.run({"months": rows}, day)
    taken = lake.bronze("months").read().select(F.col("o_orderkey").alias("k"), F.lit("taken").alias("what"))
    lost = lake.errors().select(F.get_json_object("payload", "$.o_orderkey").cast("bigint").alias("k"), F.col("motivo_error").alias("what"))
    return taken.unionByName(lost)


@query("q_late_upsert", "SELECT o_orderkey, o_totalprice FROM orders")
def _late_upsert(spark, d):
    """Old versions of a third of the orders arrive after the new ones, and don't replace them."""
    lake = Lakehouse(spark, work_dir(spark, "late"), [PRICES])
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    lake.run({"prices": _seen(orders, 9)}, DAYS[0])
    old = _seen(orders.filter(F.col("o_orderkey") % 3 == 0).withColumn("o_totalprice", F.lit(-1.0)), 5)
    lake.run({"prices": _seen(orders, 9).unionByName(old)}, DAYS[1])
    return lake.silver("prices").read().select("o_orderkey", "o_totalprice")


@query("q_same_stamp_update", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, 1 + CAST(o_orderkey % 3 = 0 AS BIGINT) AS loads
FROM orders
""")
def _same_stamp(spark, d):
    """A third of the orders get a new price without a new stamp. It reaches silver, and rows that didn't change aren't loaded again."""
    lake = Lakehouse(spark, work_dir(spark, "same"), [PRICES])
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    lake.run({"prices": _seen(orders, 9)}, DAYS[0])
    corrected = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    for day in DAYS[1:]:
        lake.run({"prices": _seen(orders.withColumn("o_totalprice", corrected), 9)}, day)
    loads = lake.bronze("prices").read().groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("loads"))
    return lake.silver("prices").read().select("o_orderkey", "o_totalprice").join(loads, "o_orderkey")


# ---- three runs through all layers --------------------------------------------------------------------------------------

CUSTOMERS = TableSpec(
    "customer", columns("c_custkey long, c_nationkey integer, c_mktsegment string, c_acctbal double"), keys=["c_custkey"],
    date_column="seen", watermark="seen",
)
ORDERS = TableSpec(
    "orders", columns("o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"), keys=["o_orderkey"],
    date_column="o_orderdate", date_parts=("_anio", "_mes"), watermark="seen", parents=[ForeignKey("o_custkey", "customer", "c_custkey")],
)
BROKEN = TableSpec("broken", columns("k long"), keys=["k"], date_column="seen", watermark="seen")
SEGMENTS = Mart(
    "segments", ["c_mktsegment"], [],
    lambda t, run: t["customer"].filter("c_acctbal > 0").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_customers")),
    "customer", nullable_keys=True,
)
FACT = Mart(
    "fact", ["o_orderkey"], ["anio"],
    lambda t, run: t["orders"]
    .select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("anio"), F.month("o_orderdate").alias("mes"))
    .join(t["customer"].select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey"),
    "orders", "o_orderkey", dims={"customer": ("o_custkey", "c_custkey")},
)
MONTHLY = Kpi(
    "monthly", ["fact"], partition_by=("anio",),
    rollup=Rollup(
        ("anio", "mes", "c_mktsegment"), {"value": lambda: F.col("o_totalprice").cast("decimal(14,2)")}, {}, {"price": "o_totalprice"},
        lambda: [F.col("_n").alias("n_orders"), F.col("_s_value").cast("decimal(38,2)").alias("value"), F.col("_m_price").alias("max_price")],
    ),
)


def three_runs(spark, d) -> Lakehouse:
    """Run 1: all customers, orders until 1998, and a source that fails. Run 2: the other orders; customers of five nations
    lose their segment. Run 3: every seventh order moves a month on; customers of one segment lose their balance."""
    return built(spark, d, "three runs", _three_runs)


def _three_runs(spark, d) -> Lakehouse:
    lake = Lakehouse(spark, work_dir(spark, "layers"), [CUSTOMERS, ORDERS, BROKEN], [SEGMENTS, FACT], [MONTHLY])
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    early = F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    customers = [_seen(customer, 1)]
    customers.append(_seen(customer.filter("c_nationkey < 5").withColumn("c_mktsegment", F.lit(None).cast("string")), 2))
    poor = customer.filter("c_nationkey >= 5 AND c_mktsegment = 'MACHINERY'").withColumn("c_acctbal", F.lit(0.0))
    customers.append(_seen(poor, 3))
    parts = [_seen(orders.filter(early), 1), _seen(orders.filter(~early), 2)]
    parts.append(_seen(orders.filter("o_orderkey % 7 = 0").withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 1 MONTH")), 3))

    def unreachable(since):
        raise RuntimeError("no connection")

    known_customers, known_orders = customers[0], parts[0]
    for k, day in enumerate(DAYS):
        if k:
            known_customers, known_orders = known_customers.unionByName(customers[k]), known_orders.unionByName(parts[k])
        lake.run({"customer": known_customers, "orders": known_orders, "broken": unreachable}, day, fail=False)
    return lake


FINAL_SQL = """
c AS (SELECT c_custkey, CASE WHEN c_nationkey >= 5 THEN c_mktsegment END AS c_mktsegment,
             CASE WHEN c_nationkey >= 5 AND c_mktsegment = 'MACHINERY' THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer),
o AS (SELECT o_orderkey, o_custkey, o_totalprice,
             CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 1 MONTH ELSE o_orderdate END AS day FROM orders),
f AS (SELECT o_orderkey, o_totalprice, CAST(year(day) AS INTEGER) AS anio, CAST(month(day) AS INTEGER) AS mes, c_mktsegment
      FROM o LEFT JOIN c ON o_custkey = c_custkey WHERE o_custkey IN (SELECT c_custkey FROM customer))"""


@query("q_three_run_kpi_monthly", f"""
WITH {FINAL_SQL}
SELECT anio, mes, c_mktsegment, CAST(count(*) AS BIGINT) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(14, 2))) AS DECIMAL(38, 2)) AS value,
       max(o_totalprice) AS max_price
FROM f GROUP BY ALL
""")
def _three_run_kpi(spark, d):
    return three_runs(spark, d).gold("monthly").read().select("anio", "mes", "c_mktsegment", "n_orders", "value", "max_price")


@query("q_three_run_mart_null_keys", f"""
WITH {FINAL_SQL}
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n_customers FROM c WHERE c_acctbal > 0 GROUP BY ALL
""")
def _three_run_segments(spark, d):
    """A whole rebuild keeps the row without a segment, and removes that of the segment that lost its customers."""
    return three_runs(spark, d).gold("segments").read().select("c_mktsegment", "n_customers")


@query("q_three_run_feed", f"""
WITH {FINAL_SQL}, before AS (SELECT DISTINCT c_mktsegment FROM c WHERE c_mktsegment = 'MACHINERY')
SELECT c_mktsegment, 'delete' AS _change_type FROM before
""")
def _three_run_feed(spark, d):
    lake = three_runs(spark, d)
    return lake.gold("segments").feed(1).filter("_change_type = 'delete'").select("c_mktsegment", "_change_type")


@query("q_three_run_log", """
WITH n AS (SELECT count(*) AS c, count(*) FILTER (c_nationkey < 5) AS c2,
                  count(*) FILTER (c_nationkey >= 5 AND c_mktsegment = 'MACHINERY') AS c3 FROM customer),
m AS (SELECT count(*) FILTER (o_orderdate < TIMESTAMP '1999-01-01') AS o, count(*) FILTER (o_orderdate >= TIMESTAMP '1999-01-01') AS o2,
             count(*) FILTER (o_orderkey % 7 = 0) AS o3 FROM orders)
SELECT capa, tabla, run, CAST(n AS BIGINT) AS registros_procesados, estado FROM (
  SELECT unnest(['bronze', 'silver']) AS capa, * FROM (
    SELECT 'customer' AS tabla, 1 AS run, c AS n, 'EXITOSO' AS estado FROM n UNION ALL SELECT 'customer', 2, c2, 'EXITOSO' FROM n
    UNION ALL SELECT 'customer', 3, c3, 'EXITOSO' FROM n UNION ALL SELECT 'orders', 1, o, 'EXITOSO' FROM m
    UNION ALL SELECT 'orders', 2, o2, 'EXITOSO' FROM m UNION ALL SELECT 'orders', 3, o3, 'EXITOSO' FROM m)
  UNION ALL SELECT 'bronze', 'broken', unnest([1, 2, 3]), 0, 'ERROR'
  UNION ALL SELECT 'silver', 'broken', unnest([1, 2, 3]), 0, 'SIN_CAMBIOS')
""")
def _three_run_log(spark, d):
    """A source that fails is logged and stops no other table."""
    log = three_runs(spark, d).run_log().filter(F.col("capa") != "gold")
    return log.select("capa", "tabla", F.dayofmonth("ts_ejecucion").alias("run"), "registros_procesados", "estado")


@query("q_missing_parent", "SELECT o_orderkey AS k, 'FK_INVALIDA: o_custkey no existe en customer' AS motivo_error FROM orders")
def _missing_parent(spark, d):
    """The first day on which a child has rows and its parent none: the run goes on, and the rows are quarantined."""
    lake = Lakehouse(spark, work_dir(spark, "orphans"), [CUSTOMERS, ORDERS], [FACT], [MONTHLY])
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    lake.run({"orders": _seen(orders, 1)}, DAYS[0])
    return lake.errors().select(F.get_json_object("payload", "$.o_orderkey").cast("bigint").alias("k"), "motivo_error")


# ---- alerts kept up to date ---------------------------------------------------------------------------------------------

SEEN = TableSpec(
    "visits", columns("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"), keys=["o_orderkey"],
    date_column="o_orderdate", date_parts=("_anio",), watermark="seen",
)
PLACED = Mart(
    "placed", ["id_encuentro"], [],
    lambda t, run: t["visits"].select(
        F.col("o_orderkey").alias("o_orderkey"), F.col("o_orderkey").alias("id_encuentro"), "o_custkey",
        F.col("o_orderdate").alias("fec_registro"), F.col("o_orderpriority").alias("diag_cie10_3char"),
    ).join(t["customer"].select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nom_ciudad")), "o_custkey", "left"),
    "visits", "o_orderkey", dims={"customer": ("o_custkey", "c_custkey")},
)
WEEKS = Kpi("weeks", ["placed"], partition_by=("anio",), rollup=marts.WEEKLY, prepare=marts.by_week)
OUTBREAKS = Watch(
    "outbreaks", "weeks", marts.SERIES, marts.WEEK, "volumen_actual", lambda compared, run: marts.alerts_of(compared, run.at, run.batch_id),
    partition_by=("anio",),
)


def _alerts_sql(state: str, day: str, city: str) -> str:
    return f"""
{state}_weekly AS (
  SELECT CAST(isoyear({day}) AS INTEGER) AS anio, CAST(week({day}) AS INTEGER) AS semana, {city} AS ciudad,
         o_orderpriority AS codigo_cie10, CAST(count(*) AS BIGINT) AS volumen_actual
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
{state}_compared AS (
  SELECT *, avg(volumen_actual) OVER (PARTITION BY ciudad, codigo_cie10 ORDER BY anio, semana
                                      ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS m FROM {state}_weekly),
{state} AS (
  SELECT anio, semana, ciudad, codigo_cie10, volumen_actual, round(m, 2) AS promedio_historico,
         round((volumen_actual - m) / m * 100, 2) AS pct_desviacion
  FROM {state}_compared WHERE m > 0 AND round((volumen_actual - m) / m * 100, 2) > 40)"""


MOVED_SQL = "CASE WHEN o_orderkey % 64 = 5 THEN o_orderdate + INTERVAL 7 DAY ELSE o_orderdate END"
TWO_RUN_ALERTS_SQL = f"""
WITH {_alerts_sql("early", "o_orderdate", "c_nationkey")},
{_alerts_sql("late", MOVED_SQL, "CASE WHEN c_nationkey = 3 AND c_custkey % 5 = 0 THEN 4 ELSE c_nationkey END")}"""


def two_alert_runs(spark, d) -> Lakehouse:
    """Run 2 moves some visits to the week after and some patients to another city: weeks lose all visits, alerts come, go and change."""
    return built(spark, d, "two alert runs", _two_alert_runs)


def _two_alert_runs(spark, d) -> Lakehouse:
    lake = Lakehouse(spark, work_dir(spark, "alerts"), [CUSTOMERS, SEEN], [PLACED], [WEEKS, OUTBREAKS])
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    lake.run({"customer": _seen(customer, 1), "visits": _seen(orders, 1)}, DAYS[0])
    moved = customer.filter("c_nationkey = 3 AND c_custkey % 5 = 0").withColumn("c_nationkey", F.lit(4))
    later = orders.filter("o_orderkey % 64 = 5").withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS"))
    lake.run({"customer": _seen(moved, 2), "visits": _seen(later, 2)}, DAYS[1])
    return lake


@query("q_two_run_alerts", f"""{TWO_RUN_ALERTS_SQL}
SELECT late.*, CASE WHEN early.anio IS NULL THEN 2 ELSE 1 END AS run FROM late LEFT JOIN early USING (
  anio, semana, ciudad, codigo_cie10, volumen_actual, promedio_historico, pct_desviacion)
""")
def _two_run_alerts(spark, d):
    """Alerts that no change has reached keep the run that found them."""
    return two_alert_runs(spark, d).gold("outbreaks").read().select(
        *marts.WEEK, *marts.SERIES, "volumen_actual", "promedio_historico", "pct_desviacion", F.dayofmonth("fec_alerta").alias("run")
    )


@query("q_two_run_alerts_cancelled", f"""{TWO_RUN_ALERTS_SQL}
SELECT anio, semana, ciudad, codigo_cie10, volumen_actual FROM early ANTI JOIN late USING (anio, semana, ciudad, codigo_cie10)
""")
def _two_run_alerts_cancelled(spark, d):
    feed = two_alert_runs(spark, d).gold("outbreaks").feed(0).filter("_change_type = 'delete'")
    return feed.select(*marts.WEEK, *marts.SERIES, "volumen_actual")


# ---- stamps, control rows, streams, loads -------------------------------------------------------------------------------

@query("q_stamp_modified", f"SELECT *, TIMESTAMP '{STAMP}' AS fec_modificacion FROM customer")
def _stamp_modified(spark, d):
    out = stamp_modified(table(spark, d, "customer"), STAMP)
    return out.withColumn("fec_modificacion", F.col("fec_modificacion").cast("timestamp_ntz"))


@query("q_init_watermarks", """
SELECT event_type AS tabla_nombre, max(ts) AS ultimo_proceso FROM events WHERE value > 50 GROUP BY ALL
UNION ALL SELECT DISTINCT event_type, TIMESTAMP '1900-01-01 00:00:00' FROM events
WHERE event_type NOT IN (SELECT event_type FROM events WHERE value > 50)
""")
def _init_watermarks(spark, d):
    """Each type of event starts as a new table, then reads some events."""
    events = table(spark, d, "events")
    names = sorted(r[0] for r in events.select("event_type").distinct().collect())
    read = events.filter("value > 50").select(F.col("event_type").alias("tabla_nombre"), F.col("ts").cast("timestamp").alias("ultimo_proceso"))
    marks = init_watermarks(spark, names).select("tabla_nombre", "ultimo_proceso").unionByName(read)
    return marks.groupBy("tabla_nombre").agg(F.max("ultimo_proceso").cast("timestamp_ntz").alias("ultimo_proceso"))


@query("q_stream_periodic", "SELECT * FROM events")
def _stream_periodic(spark, d):
    """The periodic trigger, stopped once it has read what there is."""
    path, schema = work_dir(spark, "stream"), table(spark, d, "events").schema
    stream = stream_files(spark, f"{d}/event[s].parquet", "parquet", nullable(schema))
    running = stream_to_parquet(stream, path, work_dir(spark, "checkpoint"), once=False, interval="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(schema).parquet(path)


LATE_SQL = """
WITH first AS (SELECT max(ts) - INTERVAL 2 DAY AS mark FROM events WHERE event_id % 10 <> 0 AND event_id % 3 <> 0),
marked AS (SELECT *, event_id % 10 = 0 OR event_id % 3 = 0 AS second, ts < (SELECT mark FROM first) AS old FROM events)
"""


def late_stream(spark, d) -> tuple:
    """Two landings of events, each with copies. What the second brings from more than two days before the first's end is too late;
    copies of what the first brought come again with it."""
    return built(spark, d, "late stream", _late_stream)


def _late_stream(spark, d) -> tuple:
    landing, root = work_dir(spark, "landing"), work_dir(spark, "late")
    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    second = F.expr("event_id % 10 = 0 OR event_id % 3 = 0")
    for rows in (events.filter(~second), events.filter(second).unionByName(events.filter(~second & F.expr("event_id % 7 = 0")))):
        # A restart: each call goes on from the checkpoints of the one before.
        twice = rows.unionByName(rows.filter("event_id % 5 = 1"))
        twice.write.mode("append").parquet(landing)
        stream = stream_files(spark, landing, "parquet", nullable(events.schema))
        load_on_time(stream, ["event_id"], "ts", "2 days", root)
    return root, events.schema


@query("q_stream_late", LATE_SQL + "SELECT event_id, ts, value FROM marked WHERE NOT (second AND old)")
def _stream_late(spark, d):
    root, schema = late_stream(spark, d)
    return on_time(spark, schema, root).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


@query("q_stream_too_late", LATE_SQL + """
SELECT event_id, 'FUERA_DE_MARCA' AS motivo_error, 1 + CAST(event_id % 5 = 1 AS INTEGER) AS n FROM marked
WHERE old AND (second OR event_id % 7 = 0)
""")
def _stream_too_late(spark, d):
    root, schema = late_stream(spark, d)
    rows = too_late(spark, schema, root).groupBy("event_id", "motivo_error").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return rows


@query("q_load_all", """
SELECT 'customer' AS tabla, 'OK' AS estado, CAST(count(*) AS BIGINT) AS n FROM customer
UNION ALL SELECT 'broken', 'ERROR', 0 UNION ALL SELECT 'orders', 'OK', count(*) FROM orders
""")
def _load_all(spark, d):
    """Landing files of tables in order; the one in between has none."""
    loaded = {}

    def load(spec):
        if spec.name == "broken":
            raise RuntimeError("no folder")
        source, path = table(spark, d, spec.name), work_dir(spark, spec.name)
        write_landing(source, path, "parquet")
        loaded[spec.name] = read_files(spark, path, "parquet", source.schema)

    outcome = load_all(spark, [CUSTOMERS, BROKEN, ORDERS], load).select("tabla", "estado")
    counts = None
    for name, rows in loaded.items():
        one = rows.agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    return outcome.join(counts, F.col("tabla") == F.col("of"), "left").select("tabla", "estado", F.coalesce("n", F.lit(0)).alias("n"))
