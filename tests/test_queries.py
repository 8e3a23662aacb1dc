"""Every registered query against its SQL, and what its plan may contain."""

import re

import duckdb
import pytest
from oracle import connect, difference

import __spark_entry__ as entry_points
from tidemark.operators import joins
from tidemark.plans.testbed import ORACLES, QUERIES, ingest

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(testdata):
    return connect(testdata)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Neither pairs of all rows nor Python in the tasks.
UNWANTED = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|ArrowEvalPython|BatchEvalPython|InPandas|InArrow")


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, testdata, con, name):
    df = entry_points.queries()[name](spark, testdata)
    assert not UNWANTED.search(plan(df))
    assert difference(df, con, entry_points.oracle_sql()[name]) is None


def test_age_band_of_half_days_is_that_of_the_sql(spark, tmp_path):
    """364.5 and 365.5 days: SQL rounds halves to even numbers, and a day more is a year more."""
    rows = "(VALUES (1, 7290.0::DOUBLE), (2, 7310.0), (3, 7300.0)) t(o_orderkey, o_totalprice)"
    con = duckdb.connect()
    con.execute(f"CREATE TABLE orders AS SELECT o_orderkey::BIGINT AS o_orderkey, o_totalprice, TIMESTAMP '2001-12-31' AS o_orderdate FROM {rows}")
    con.execute(f"COPY orders TO '{tmp_path}/orders.parquet'")
    df = QUERIES["q_age_band"](spark, str(tmp_path))
    assert difference(df, con, ORACLES["q_age_band"]) is None
    assert {r.o_orderkey: r.age for r in df.collect()} == {1: 0, 2: 1, 3: 1}


def test_order_lines_are_shuffled_once(spark, testdata, con, tmp_path):
    """Parts and suppliers that are null or repeated don't count; before, each line was shuffled three times and orders again."""
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_partkey % 3 END AS l_partkey,
                                            CASE WHEN l_linenumber = 2 THEN NULL ELSE l_suppkey % 2 END AS l_suppkey,
                                            CASE WHEN l_orderkey % 7 <> 0 THEN l_orderkey END AS l_orderkey) FROM lineitem)
                    TO '{tmp_path}/lineitem.parquet'""")
    df = QUERIES["q_line_revenue"](spark, str(tmp_path))
    assert plan(df).count("Exchange hashpartitioning") == 1
    odd = duckdb.connect()
    odd.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    assert difference(df, odd, ORACLES["q_line_revenue"]) is None


def test_keys_of_many_rows_are_not_sent_through_the_driver(spark, testdata, con, monkeypatch):
    dim = spark.range(100).selectExpr("id AS k", "id AS v")
    joined = lambda few: plan(joins.lookup(spark.range(10).selectExpr("id AS k"), joins.merged_if_many(dim, few=few), "k"))
    assert "BroadcastExchange" in joined(100) and "BroadcastExchange" not in joined(99)
    # Parents, held stamps and changed keys of two whole runs: the same results either way.
    monkeypatch.setattr(joins, "FEW_ROWS", -1)
    lake = ingest._two_runs(spark, testdata)
    monkeypatch.setattr(ingest, "two_runs", lambda *_: lake)
    for name in ("q_two_run_errors", "q_two_run_clean"):
        assert difference(QUERIES[name](spark, testdata), con, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry_points.entry(spark), entry_points.entry(spark)
    assert first.schema == second.schema and first.count() > 0


def test_nothing_is_broadcast_by_force(spark, testdata):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("q_fact_orders", "q_fact_lag", "q_fk_split", "q_merge_upsert", "q_kpi_executive"):
            assert "BroadcastExchange" not in plan(entry_points.queries()[name](spark, testdata))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_scan_takes_the_watermark_and_few_columns(spark, testdata):
    text = plan(entry_points.queries()["q_incremental_scan"](spark, testdata))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts,", text)
    text = plan(entry_points.queries()["q_capacity_pct"](spark, testdata))
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def test_a_repeated_key_is_cut_before_the_shuffle(spark, testdata):
    for name in ("q_dedup_latest", "q_volume_anomaly"):
        text = plan(entry_points.queries()[name](spark, testdata))
        exchange = text.rindex("Exchange hashpartitioning(l_orderkey") if "dedup" in name else text.index("Exchange")
        assert re.search(r"WindowGroupLimit .*Partial", text[exchange:])
