"""Rollups by deltas against rollups of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as ch
from tidemark.operators.rollup import AGAIN, Rollup

ROLLUP = Rollup(
    ["g"], {"v": lambda: F.col("v")}, {"s": "s"}, {"v": "v", "s": "s"},
    lambda: [F.col("_n").alias("n"), F.col("_s_v").alias("sum"), F.col("_m_v").alias("top"), F.col("_c_s").alias("texts")],
)
SCHEMA = "id int, g string, v int, s string"


def plain(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def state(rng, n=60):
    """Groups of all sizes, a null one among them, with ties and nulls."""
    pick = lambda *x: rng.choice(x)
    return [(i, pick("a", "b", "c", None, f"g{i % 9}"), pick(None, 1, 2, 3, i % 11), pick(None, "x", "y", str(i))) for i in range(n) if rng.random() < 0.7]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deltas_equal_a_full_build(spark, seed):
    rng = random.Random(seed)
    states = [spark.createDataFrame(state(rng), SCHEMA) for _ in range(3)]
    parts, again_rows = ROLLUP.aggregate(states[0]), 0
    for old, new in zip(states, states[1:]):
        deltas = ROLLUP.deltas(ch.change_feed(old, new, ["id"]))
        merged = ROLLUP.merged(parts, deltas)
        again = merged.filter(AGAIN).select("g").collect()
        again_rows += len(again)
        groups = {r.g for r in again}
        whole = ROLLUP.aggregate(new).filter(F.coalesce("g", F.lit("-")).isin([g or "-" for g in groups]) if groups else F.lit(False))
        touched = [r.g for r in deltas.select("g").collect()]
        kept = parts.filter(~F.coalesce("g", F.lit("-")).isin([g or "-" for g in touched]))
        rows = kept.unionByName(merged.filter(~F.col(AGAIN)).drop(AGAIN)).unionByName(whole).collect()
        parts = spark.createDataFrame(rows, ROLLUP.aggregate(new).schema)
        assert plain(parts) == plain(ROLLUP.aggregate(new))
        assert plain(ROLLUP.published(parts)) == plain(ROLLUP.build(new))
    assert again_rows > 0


def test_several_versions_at_once(spark):
    """A greatest value that came and went between two readings of the feed is not taken for one that stayed."""
    states = [spark.createDataFrame(rows, SCHEMA) for rows in ([(1, "a", 5, None)], [(1, "a", 9, None)], [(1, "a", 4, None), (2, "a", 3, "x")])]
    feed = ch.change_feed(states[0], states[1], ["id"], 1).unionByName(ch.change_feed(states[1], states[2], ["id"], 2))
    row = ROLLUP.merged(ROLLUP.aggregate(states[0]), ROLLUP.deltas(feed)).first()
    assert (row._n, row._s_v, row._c_s, row[AGAIN]) == (2, 7, 1, True)


def test_groups_come_and_go_without_being_read_again(spark):
    old = spark.createDataFrame([(1, "a", 5, "x"), (2, "a", 3, "x"), (3, "gone", 1, None)], SCHEMA)
    new = spark.createDataFrame([(1, "a", 5, "x"), (4, "new", None, None)], SCHEMA)
    merged = {r.g: r for r in ROLLUP.merged(ROLLUP.aggregate(old), ROLLUP.deltas(ch.change_feed(old, new, ["id"]))).collect()}
    # 'a' lost a lesser number, but a text that may have been its last; the new group's sum has no summand.
    assert set(merged) == {"a", "new"} and merged["a"][AGAIN] and not merged["new"][AGAIN]
    assert (merged["new"]._n, merged["new"]._s_v, merged["new"]._m_v) == (1, None, None)
    numbers = Rollup(["g"], {"v": lambda: F.col("v")}, {}, {"v": "v"})
    row = numbers.merged(numbers.aggregate(old), numbers.deltas(ch.change_feed(old, new, ["id"]))).filter("g = 'a'").first()
    assert (row._n, row._s_v, row._m_v, row[AGAIN]) == (1, 5, 5, False)
