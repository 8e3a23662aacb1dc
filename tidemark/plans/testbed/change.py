"""Upserts, change feeds, ledgers and keyed tables on the test tables.

The keyed state is each customer's activity before a date, as long as they have ordered lately: between two dates customers
appear, change, stay as they are and disappear. The last date lies after all orders.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import apply_changes, change_feed, merge_upsert, undo_changes
from tidemark.operators.incremental import latest_version, ledger_get, read_changes, update_where
from tidemark.plans.testbed.base import built, query, table
from tidemark.session import work_dir
from tidemark.sources.tables import LakeTable

KEYS = ["o_custkey"]
#: (before which date, since when at least the last order)
DATES = (("1998-06-01", "1996-06-01"), ("2001-03-01", "1999-12-01"), ("2003-01-01", "2000-06-01"))


def activity(spark, d, dates: tuple[str, str]) -> DataFrame:
    """Customers with all their orders before a date, if the last one isn't too old."""
    when = F.col("o_orderdate")
    upto, since = (F.lit(x).cast("timestamp_ntz") for x in dates)
    return (
        table(spark, d, "orders")
        .filter(when < upto)
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(24,2)").alias("spent"),
            F.max(when).alias("last"),
        )
        .filter(F.col("last") >= since)
        .select("o_custkey", "n_orders", "spent", F.year("last").alias("last_year"))
    )


def _state_sql(name: str, dates: tuple[str, str]) -> str:
    return f"""
{name} AS (
  SELECT o_custkey, CAST(count(*) AS BIGINT) AS n_orders,
         CAST(sum(CAST(o_totalprice AS DECIMAL(12, 2))) AS DECIMAL(24, 2)) AS spent,
         CAST(year(max(o_orderdate)) AS INTEGER) AS last_year
  FROM orders WHERE o_orderdate < TIMESTAMP '{dates[0]}' GROUP BY o_custkey HAVING max(o_orderdate) >= TIMESTAMP '{dates[1]}'
)"""


STATES_SQL = ",".join(_state_sql(f"s{i + 1}", dates) for i, dates in enumerate(DATES))


def _changed_sql(old: str, new: str) -> str:
    """Rows of ``new`` that are not in ``old`` as they are."""
    return f"SELECT * FROM {new} EXCEPT SELECT * FROM {old}"


def _feed_sql(old: str, new: str, version: int) -> str:
    columns = "o_custkey, n_orders, spent, last_year"
    return f"""
SELECT {columns}, 'insert' AS _change_type, CAST({version} AS BIGINT) AS _commit_version FROM {new}
  WHERE o_custkey NOT IN (SELECT o_custkey FROM {old})
UNION ALL SELECT {columns}, 'delete', {version} FROM {old} WHERE o_custkey NOT IN (SELECT o_custkey FROM {new})
UNION ALL SELECT {columns}, 'update_postimage', {version} FROM ({_changed_sql(old, new)})
  WHERE o_custkey IN (SELECT o_custkey FROM {old})
UNION ALL SELECT {columns}, 'update_preimage', {version} FROM ({_changed_sql(new, old)})
  WHERE o_custkey IN (SELECT o_custkey FROM {new})"""


def feed_of(spark, d, old: tuple[str, str], new: tuple[str, str], version: int) -> DataFrame:
    return change_feed(activity(spark, d, old), activity(spark, d, new), KEYS, version)


def full_feed(spark, d) -> DataFrame:
    """Three versions: the first state from nothing, then two changes of it."""
    first = activity(spark, d, DATES[0])
    return (
        change_feed(first.filter(F.lit(False)), first, KEYS, 1)
        .unionByName(feed_of(spark, d, DATES[0], DATES[1], 2))
        .unionByName(feed_of(spark, d, DATES[1], DATES[2], 3))
    )


@query("q_change_feed", f"WITH {STATES_SQL} {_feed_sql('s2', 's3', 7)}")
def _change_feed(spark, d):
    return feed_of(spark, d, DATES[1], DATES[2], 7).drop("_commit_timestamp")


@query("q_apply_changes", f"WITH {STATES_SQL} SELECT * FROM s3")
def _apply_changes(spark, d):
    return apply_changes(activity(spark, d, DATES[1]), feed_of(spark, d, DATES[1], DATES[2], 7), KEYS)


@query("q_undo_changes", f"WITH {STATES_SQL} SELECT * FROM s1")
def _undo_changes(spark, d):
    """Two versions back from the last state."""
    return undo_changes(activity(spark, d, DATES[2]), full_feed(spark, d).filter("_commit_version > 1"), KEYS)


@query("q_merge_upsert", f"""
WITH {STATES_SQL}
SELECT *, NULL::BIGINT AS extra FROM s2 WHERE o_custkey NOT IN (SELECT o_custkey FROM s3)
UNION ALL SELECT *, n_orders * 2 FROM s3
""")
def _merge_upsert(spark, d):
    newer = activity(spark, d, DATES[2]).withColumn("extra", F.col("n_orders") * 2)
    return merge_upsert(activity(spark, d, DATES[1]), newer, KEYS)


@query("q_read_changes", f"""
WITH {STATES_SQL}, c2 AS ({_changed_sql('s1', 's2')}), c3 AS ({_changed_sql('s2', 's3')})
SELECT * FROM c3 UNION ALL SELECT * FROM c2 WHERE o_custkey NOT IN (SELECT o_custkey FROM c3)
""")
def _read_changes(spark, d):
    return read_changes(full_feed(spark, d), 1, KEYS)


@query("q_latest_version", f"""
WITH {STATES_SQL}, f AS ({_feed_sql('s1', 's2', 2)} UNION ALL {_feed_sql('s2', 's3', 3)})
SELECT max(_commit_version) AS version FROM f
""")
def _latest_version(spark, d):
    return latest_version(full_feed(spark, d))


@query("q_ledger_get", """
SELECT coalesce(max(event_id), -1) AS ultima_version, 'known' AS kind FROM events WHERE event_type = 'view' AND user_id = 7
UNION ALL SELECT -1, 'new'
""")
def _ledger_get(spark, d):
    """Events as the entries of a ledger: a type is a consumer, a user is a table."""
    ledger = table(spark, d, "events").select(
        F.col("event_type").alias("consumidor"), F.col("user_id").cast("string").alias("tabla"),
        F.col("event_id").alias("ultima_version"),
    )
    known = ledger_get(ledger, "view", "7").withColumn("kind", F.lit("known"))
    return known.unionByName(ledger_get(ledger, "nobody", "7").withColumn("kind", F.lit("new")))


@query("q_update_where", """
SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_totalprice > 300000 THEN 0.0 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM orders
""")
def _update_where(spark, d):
    return update_where(
        table(spark, d, "orders"), F.col("o_totalprice") > 300000, {"o_orderstatus": F.lit("X"), "o_totalprice": F.lit(0.0)}
    )


def lake_table(spark, d) -> LakeTable:
    return built(spark, d, "activity", _lake_table)


def _lake_table(spark, d) -> LakeTable:
    """A keyed table in buckets that has taken in three states. Customers who aren't in the last one any more are deleted then."""
    lake = LakeTable(spark, work_dir(spark, "lake"), keys=KEYS, partition_by=["last_year"], buckets=5)
    for day, dates in enumerate(DATES, start=1):
        scope = lake.read().select(*KEYS) if day == len(DATES) else None
        lake.upsert(activity(spark, d, dates), datetime(2024, 1, day), scope=scope)
    return lake


MERGED_SQL = "m2 AS (SELECT * FROM s1 WHERE o_custkey NOT IN (SELECT o_custkey FROM s2) UNION ALL SELECT * FROM s2)"


@query("q_lake_upsert", f"WITH {STATES_SQL} SELECT * FROM s3")
def _lake_upsert(spark, d):
    return lake_table(spark, d).read()


@query("q_lake_time_travel", f"WITH {STATES_SQL}, {MERGED_SQL} SELECT *, 1 AS version FROM m2 UNION ALL SELECT *, 0 FROM s1")
def _lake_time_travel(spark, d):
    lake = lake_table(spark, d)
    return lake.read(version=1).withColumn("version", F.lit(1)).unionByName(lake.read(version=0).withColumn("version", F.lit(0)))


@query("q_lake_feed", f"""
WITH {STATES_SQL}, {MERGED_SQL}, f AS ({_feed_sql('s1', 's2', 1)}) SELECT * FROM f WHERE _change_type <> 'delete'
UNION ALL {_feed_sql('m2', 's3', 2)}
""")
def _lake_feed(spark, d):
    return lake_table(spark, d).feed(since=0).drop("_commit_timestamp")
