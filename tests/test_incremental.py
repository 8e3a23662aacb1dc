from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import anomaly, incremental as inc
from tidemark.sources import files, inventory, jdbc
from tidemark.spec import columns

WM = datetime(2024, 1, 1, 10, 0, 0)


def stamps(spark):
    rows = [
        (1, datetime(2024, 1, 1, 9, 0)), (2, WM), (3, datetime(2024, 1, 1, 10, 0, 0, 500000)), (4, None),
        (5, datetime(2024, 1, 1, 11, 0)),
    ]
    return spark.createDataFrame(rows, "id int, ts timestamp")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string"])
def test_scan_is_strict(spark, kind):
    df = stamps(spark).withColumn("ts", F.col("ts").cast(kind))
    assert {r.id for r in inc.incremental_scan(df, "ts", WM).collect()} == {3, 5}
    assert {r.id for r in inc.incremental_scan(df, "ts", datetime(1900, 1, 1)).collect()} == {1, 2, 3, 5}


def test_late_rows_come_once(spark):
    df = stamps(spark)
    seen = df.filter("id in (2)")
    late = inc.unseen(inc.incremental_scan(df, "ts", WM, "2 hours"), seen, ["id"], "ts")
    assert {r.id for r in late.collect()} == {1, 3, 5}


def test_watermark_modes(spark):
    stamp = F.lit(datetime(2024, 1, 1, 10, 0, 0, 500000))
    df = spark.range(1).select(inc.next_watermark(stamp).alias("a"), inc.next_watermark(stamp, "second_plus_one").alias("b"))
    assert df.first()[:] == (datetime(2024, 1, 1, 10, 0, 0, 500000), datetime(2024, 1, 1, 10, 0, 1))
    with pytest.raises(ValueError):
        inc.next_watermark(stamp, "other")


def test_watermark_table(spark):
    marks = inc.init_watermarks(spark, ["A", "B"])
    assert inc.get_watermark(marks, "A").first()[0] == datetime(1900, 1, 1)
    assert inc.get_watermark(marks, "none").first()[0] == datetime(1900, 1, 1)
    moved = inc.advance_watermark(marks, "A", WM, datetime(2024, 2, 2), "second_plus_one")
    assert inc.get_watermark(moved, "A").first()[0] == datetime(2024, 1, 1, 10, 0, 1)
    assert inc.get_watermark(moved, "B").first()[0] == datetime(1900, 1, 1)
    assert inc.high_watermark(stamps(spark), "ts").first()[0] == datetime(2024, 1, 1, 11, 0)


def test_ledger_is_per_consumer(spark):
    ledger = inc.ledger_row(spark, "fact_a", "visits", 4, WM).unionByName(
        inc.ledger_row(spark, "fact_b", "visits", 2, WM)
    )
    assert inc.ledger_get(ledger, "fact_a", "visits").first()[0] == 4
    assert inc.ledger_get(ledger, "fact_b", "visits").first()[0] == 2
    assert inc.ledger_get(ledger, "fact_c", "visits").first()[0] == -1


def test_audit_and_parts(spark):
    df = spark.createDataFrame([("2024-02-03",), ("never",), (None,)], "d string")
    out = inc.with_date_parts(inc.with_audit(df, "src", "b1", WM), "d")
    assert [(r["_anio"], r["_mes"], r["_dia"]) for r in out.collect()] == [(2024, 2, 3), (None,) * 3, (None,) * 3]
    assert inc.drop_audit(out).columns == ["d"]


def test_run_log_keeps_whole_messages(spark):
    row = inc.run_log_row(spark, "bronze", "t", "b", WM, 3, "ERROR", "x" * 900).first()
    assert len(row.mensaje) == 900 and row.registros_procesados == 3 and row.tamano_mb is None


# ---- files ----------------------------------------------------------------------------------------------------

SCHEMA = columns("id long!, name string, price double, day date, gone long")


def test_conform(spark):
    df = spark.createDataFrame(
        [("1", "a", "2.345", "2024-01-01", "x", "r"), ("zz", None, "n/a", "never", "y", "r")],
        "id string, name string, price string, day string, more string, _rescued_data string",
    )
    out = files.conform_schema(df, SCHEMA, {"price": (10, 2), "other": (10, 2)})
    assert out.columns == ["id", "name", "price", "day", "more"]
    assert out.schema["price"].dataType.simpleString() == "decimal(10,2)"
    good, bad = out.collect()
    assert (good.id, float(good.price), str(good.day)) == (1, 2.35, "2024-01-01")
    assert (bad.id, bad.price, bad.day) == (None, None, None)
    stamped = files.stamp_modified(out, WM)
    assert stamped.first()["fec_modificacion"] == WM


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_landing_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, None, 1.5), (2, "ñ, \"q\"", None)], "id bigint, name string, price double")
    path = str(tmp_path / fmt)
    files.write_landing(df, path, fmt, files=1)
    back = files.read_files(spark, path, fmt, df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, None, 1.5), (2, "ñ, \"q\"", None)]


def test_empty_csv_field_is_null_and_bad_line_survives(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,\nx,b\n3,c,extra\n")
    got = files.read_files(spark, str(tmp_path), "csv", "id bigint, name string").collect()
    assert [tuple(r) for r in got] == [(1, None), (None, "b"), (3, "c")]


def test_read_or_empty(spark, tmp_path):
    empty = files.read_or_empty(spark, str(tmp_path / "nothing"), "a int")
    assert empty.isEmpty() and empty.columns == ["a"]
    spark.createDataFrame([], "a int, p int").write.partitionBy("p").parquet(str(tmp_path / "e"))
    assert files.read_or_empty(spark, str(tmp_path / "e"), "a int, p int").columns == ["a", "p"]


def test_inventories(spark):
    a, b = spark.range(5).toDF("k"), spark.range(0).toDF("k")
    assert {tuple(r) for r in inventory.key_offsets({"a": (a, "k"), "b": (b, "k")}).collect()} == {("a", 4), ("b", 0)}
    assert {tuple(r) for r in inventory.row_counts({"a": a, "b": b}).collect()} == {("a", 5), ("b", 0), ("TOTAL", 5)}


def test_jdbc_queries():
    """The texts only: reading and writing need a database, which tests do not start."""
    assert jdbc.incremental_query("t") == "SELECT * FROM t"
    late = datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert jdbc.incremental_query("t", "m", late) == (
        "SELECT * FROM t WHERE CAST(m AS TIMESTAMP) >= '2024-01-02 03:04:05' OR m IS NULL"
    )
    assert "CAST(m AS DATETIME)" in jdbc.incremental_query("t", "m", late, "DATETIME")
    assert jdbc.key_offsets_query({"a": "k"}) == "SELECT 'a' AS tabla, COALESCE(MAX(k), 0) AS max_id FROM a"


# ---- baselines --------------------------------------------------------------------------------------------------

def test_rolling_baseline_edges(spark):
    rows = [("x", w, 100) for w in range(1, 9)] + [("x", 9, 140), ("x", 10, 141), ("y", 1, 5)]
    df = spark.createDataFrame(rows, "g string, w int, n int")
    out = anomaly.rolling_baseline(df, "n", ["g"], ["w"], mean="m", deviation="d")
    got = {(r.g, r.w): (r.m, r.d) for r in out.collect()}
    assert got["x", 1] == (None, None) and got["y", 1] == (None, None)
    assert got["x", 2] == (100.0, 0.0)
    assert got["x", 9] == (100.0, 40.0)
    assert got["x", 10] == (105.0, 34.29)  # the first week has left the window
    strict = anomaly.rolling_baseline(df, "n", ["g"], ["w"], min_rows=8, deviation="d")
    assert {r.w for r in strict.filter("d is not null").collect()} == {9, 10}


def test_fill_missing_weeks(spark):
    df = spark.sql("SELECT 'x' AS g, DATE'2024-01-01' AS w, 3L AS n UNION ALL SELECT 'x', DATE'2024-01-22', 4L")
    got = {str(r.w): r.n for r in anomaly.fill_missing_weeks(df, ["g"], "w", "n").collect()}
    assert got == {"2024-01-01": 3, "2024-01-08": 0, "2024-01-15": 0, "2024-01-22": 4}


def runs(spark, counts, status="EXITOSO", table="t"):
    rows = [("bronze", table, datetime(2024, 1, i + 1), n, status) for i, n in enumerate(counts)]
    return spark.createDataFrame(
        rows, "capa string, tabla string, ts_ejecucion timestamp, registros_procesados bigint, estado string"
    )


@pytest.mark.parametrize(
    ("counts", "found"),
    [
        ([100, 100, 200], None),  # two earlier runs are too few
        ([100, 100, 100, 200], (200, 100.0, 100.0)),
        ([100, 100, 100, 130], None),  # exactly 30 %
        ([0, 0, 0, 50], None),  # no mean to compare with
        ([900] + [100] * 7 + [140], (140, 100.0, 40.0)),  # the eighth run back is out of the window
        ([100] * 6 + [60], (60, 100.0, 40.0)),
    ],
)
def test_volume_anomalies(spark, counts, found):
    got = anomaly.volume_anomalies(runs(spark, counts), detected_at="now").collect()
    assert [(r.n_actual, r.n_promedio, r.pct_desviacion) for r in got] == ([found] if found else [])


def test_failed_runs_are_no_history(spark):
    log = runs(spark, [100, 100, 100, 110]).unionByName(
        runs(spark, [0] * 6, "ERROR").withColumn("ts_ejecucion", F.lit(datetime(2024, 2, 1)))
    )
    assert anomaly.volume_anomalies(log).isEmpty()


def test_record_and_fail(spark):
    none = anomaly.volume_anomalies(runs(spark, [1, 1, 1, 1]))
    assert [r.estado for r in anomaly.anomaly_record(none, "now").collect()] == ["OK"]
    anomaly.fail_on_anomalies(none)
    some = anomaly.volume_anomalies(runs(spark, [1, 1, 1, 9]))
    assert [r.estado for r in anomaly.anomaly_record(some, "now").collect()] == ["ANOMALIA"]
    with pytest.raises(anomaly.VolumeAnomalyError, match="bronze.t"):
        anomaly.fail_on_anomalies(some)


def test_ties_and_missing_stamps(spark):
    rows = spark.createDataFrame([(1, WM), (2, WM), (None, WM), (3, None)], "k bigint, ts timestamp")
    seen = rows.filter("k = 1 OR k IS NULL")
    fresh = inc.unseen(inc.incremental_scan(rows, "ts", WM, inclusive=True), seen, ["k"], "ts")
    assert [r.k for r in fresh.collect()] == [2]
    assert [r.k for r in inc.undated(rows, "ts").collect()] == [3]


def test_a_late_row_is_not_merged_over_a_newer_one(spark):
    held = spark.createDataFrame([(1, WM), (2, WM), (3, None)], "k bigint, ts timestamp")
    late = datetime(2020, 1, 1)
    rows = spark.createDataFrame([(1, late), (2, WM), (3, late), (4, late), (2, None)], "k bigint, ts timestamp")
    good, older = inc.not_older(rows, held, ["k"], "ts")
    assert sorted((r.k, r.ts) for r in good.collect()) == [(2, WM), (3, late), (4, late)]
    assert sorted((r.k, r.ts is None) for r in older.collect()) == [(1, False), (2, True)]


def test_a_load_that_brought_nothing_is_an_anomaly(spark):
    days = [(d, 1000, "EXITOSO") for d in range(1, 9)] + [(9, 77, "ERROR"), (10, 0, "SIN_CAMBIOS")]
    log = spark.createDataFrame([("b", "t", datetime(2024, 1, d), n, s) for d, n, s in days], "capa string, tabla string, ts_ejecucion timestamp, registros_procesados bigint, estado string")
    (found,) = anomaly.volume_anomalies(log).collect()
    assert (found.n_actual, found.n_promedio, found.pct_desviacion) == (0, 1000.0, 100.0)
    assert anomaly.volume_anomalies(log.filter("registros_procesados > 0")).isEmpty()


@pytest.mark.parametrize("parts", [("_anio",), ("_anio", "_mes"), ("_anio", "_mes", "_dia")])
def test_pruned_scan_reads_the_same_rows_of_fewer_partitions(spark, tmp_path, parts):
    days = [datetime(y, m, d, h) for y in (2022, 2023, 2024) for m in (1, 6, 12) for d in (1, 15, 28) for h in (0, 23)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*days, None])], "id int, ts timestamp")
    dated = inc.with_date_parts(rows, "ts", parts)
    dated.write.partitionBy(*parts).parquet(f"{tmp_path}/t")
    held = spark.read.schema(dated.schema).parquet(f"{tmp_path}/t")
    for since in (datetime(2023, 6, 15, 12), datetime(2023, 12, 31), datetime(1900, 1, 1), datetime(2030, 1, 1)):
        for options in ({}, {"lateness": "40 days"}, {"inclusive": True}):
            got = inc.pruned_scan(held, "ts", since, parts, **options)
            assert {r.id for r in got.collect()} == {r.id for r in inc.incremental_scan(held, "ts", since, **options).collect()}
    scan = inc.pruned_scan(held, "ts", datetime(2023, 6, 15, 12), parts)
    assert "PartitionFilters: [" in plan_of(scan) and "_anio" in plan_of(scan).split("PartitionFilters: [")[1].split("]")[0]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
