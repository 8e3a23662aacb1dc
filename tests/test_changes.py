from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as ch
from tidemark.operators.incremental import read_changes
from tidemark.sources.tables import LakeTable

SCHEMA = "id bigint, grp string, v double"
OLD = [(1, "a", 1.0), (2, "a", 2.0), (3, "b", None), (4, "b", float("nan")), (5, "c", 5.0)]
NEW = [(2, "a", 2.0), (3, "b", 3.0), (4, "b", float("nan")), (5, "z", 5.0), (6, "z", 6.0)]


@pytest.fixture()
def old(spark):
    return spark.createDataFrame(OLD, SCHEMA)


@pytest.fixture()
def new(spark):
    return spark.createDataFrame(NEW, SCHEMA)


def as_set(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_feed_kinds(old, new):
    feed = ch.change_feed(old, new, ["id"], 3)
    kinds = sorted((r.id, r["_change_type"]) for r in feed.collect())
    assert kinds == [
        (1, "delete"), (3, "update_postimage"), (3, "update_preimage"), (5, "update_postimage"),
        (5, "update_preimage"), (6, "insert"),
    ]
    assert {r["_commit_version"] for r in feed.collect()} == {3}


def test_feed_turns_old_into_new(old, new):
    feed = ch.change_feed(old, new, ["id"])
    once = ch.apply_changes(old, feed, ["id"])
    assert as_set(once) == as_set(new)
    assert as_set(ch.apply_changes(once, feed, ["id"])) == as_set(new)


def test_feed_with_a_new_column_and_ignored_stamp(old):
    same = old.withColumn("stamp", F.lit("later"))
    assert ch.change_feed(old, same, ["id"], ignore=["stamp"]).isEmpty()
    assert ch.change_feed(old, same, ["id"]).count() == 2 * len(OLD)


def test_upsert_twice_is_upsert_once(old, new):
    once = ch.merge_upsert(old, new, ["id"])
    assert as_set(once) == as_set(ch.merge_upsert(once, new, ["id"]))
    assert {r.id: r.grp for r in once.collect()} == {1: "a", 2: "a", 3: "b", 4: "b", 5: "z", 6: "z"}


def test_upsert_refuses_repeated_or_null_keys(spark, old, new):
    with pytest.raises(ch.DuplicateKeyError):
        ch.merge_upsert(old, new.unionByName(new), ["id"])
    with pytest.raises(ch.DuplicateKeyError):
        ch.merge_upsert(old, spark.createDataFrame([(None, "a", 1.0)], SCHEMA), ["id"])


def test_read_changes_takes_the_newest_image(spark, old, new):
    first = ch.change_feed(old.filter("1=0"), old, ["id"], 1)
    feed = first.unionByName(ch.change_feed(old, new, ["id"], 2))
    assert as_set(read_changes(feed, 0, ["id"])) == sorted(
        tuple(map(str, r)) for r in [*OLD[:2], NEW[1], OLD[3], NEW[3], NEW[4]]
    )
    assert {r.id for r in read_changes(feed, 1).collect()} == {3, 5, 6}
    assert read_changes(feed, 2).isEmpty()


# ---- keyed tables -------------------------------------------------------------------------------------------------

@pytest.fixture()
def lake(spark, tmp_path):
    return LakeTable(spark, str(tmp_path / "t"), keys=["id"], partition_by=["grp"])


def at(day):
    return datetime(2024, 1, day)


def test_lake_versions(lake, old, new):
    assert lake.version() == -1 and not lake.exists()
    assert lake.upsert(old, at(1)) == 0
    assert lake.upsert(new, at(2)) == 1
    assert as_set(lake.read()) == as_set(ch.merge_upsert(old, new, ["id"]))
    assert as_set(lake.read(0)) == as_set(old)
    kinds = sorted((r.id, r["_change_type"]) for r in lake.feed(0).collect())
    assert kinds == [
        (3, "update_postimage"), (3, "update_preimage"), (5, "update_postimage"), (5, "update_preimage"), (6, "insert"),
    ]


def test_lake_upsert_again_makes_no_version(lake, old):
    lake.upsert(old, at(1))
    assert lake.upsert(old, at(2)) == 0
    assert lake.feed(0).isEmpty()


def files(tmp_path):
    return {p.relative_to(tmp_path / "t/data").as_posix() for p in (tmp_path / "t/data").rglob("*.parquet")}


def test_lake_only_replaces_buckets_with_changes(lake, spark, old, tmp_path):
    lake.upsert(old, at(1))
    before, schema = files(tmp_path), old.schema
    changed = spark.createDataFrame([(1, "b", 7.0)], SCHEMA)
    touched = lake._buckets_of(changed, schema)
    lake.upsert(changed, at(2))
    same = lambda names: {f for f in names if f.split("/")[0] != f"_bucket={touched[0]}"}
    assert len(touched) == 1 and same(before) == same(files(tmp_path)) and before != files(tmp_path)
    assert not list((tmp_path / "t/staged").glob("*"))


def test_lake_bucket_that_loses_its_last_row(spark, tmp_path):
    lake = LakeTable(spark, str(tmp_path / "t"), keys=["id"], buckets=50)
    rows = spark.createDataFrame([(i, "x", 1.0) for i in range(20)], SCHEMA)
    lake.upsert(rows, at(1))
    lake.upsert(rows.filter("id > 3"), at(2), scope=rows.select("id"))
    assert {r.id for r in lake.read().collect()} == set(range(4, 20))
    # Its mark goes with the next change of the bucket, and the row may come again.
    lake.upsert(rows.filter("id in (0, 3, 5)"), at(3))
    assert {r.id for r in lake.read().collect()} == {0, *range(3, 20)}
    assert {r.id for r in lake.read(1).collect()} == set(range(4, 20)) and lake.read(0).count() == 20
    # The number of buckets stays what it was, and what is compared by key is the key's type in the table.
    again = LakeTable(spark, str(tmp_path / "t"), keys=["id"], buckets=3)
    again.upsert(spark.createDataFrame([(5, "y", 2.0)], "id int, grp string, v double"), at(4))
    assert again.buckets == 50 and again.read().filter("id = 5").first().grp == "y" and again.read().count() == 18
    assert again.matching(spark.createDataFrame([(5,), (1,)], "id int"), ["id"]).count() == 1


def test_lake_scope_deletes(lake, spark, old, new):
    """Keys computed anew that have no row any more go; all other rows stay."""
    lake.upsert(old, at(1))
    scope = spark.createDataFrame([(1,), (2,), (77,)], "id bigint")
    lake.upsert(new.filter("id = 2"), at(2), scope=scope)
    assert as_set(lake.read()) == as_set(old.filter("id <> 1"))
    assert [(r.id, r["_change_type"]) for r in lake.feed(0).collect()] == [(1, "delete")]
    lake.upsert(new.filter("1=0"), at(3), scope=lake.read().select("id"))
    assert lake.read().isEmpty() and lake.read(1).count() == 4


def test_lake_first_load_without_rows(lake, old):
    lake.upsert(old.filter("1=0"), at(1))
    assert lake.version() == 0 and lake.read().schema.names == ["id", "grp", "v"] and lake.read().isEmpty()


def test_lake_matching_reads_only_buckets_with_hits(lake, spark, old, new):
    lake.upsert(old, at(1))
    lake.upsert(new, at(2))
    wanted = spark.createDataFrame([(2,)], "id bigint")
    found = lake.matching(wanted, ["id"])
    assert as_set(found) == as_set(old.filter("id = 2"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [(_bucket" in plan
    assert lake.matching(spark.createDataFrame([("none",)], "grp string"), ["grp"]).isEmpty()


def die(*args, **options):
    raise RuntimeError("executor lost")


def test_lake_ignores_what_a_dead_run_left(lake, old, new, monkeypatch):
    """A run that dies before its copies are staged leaves files; readers do not see them and the next run replaces them."""
    lake.upsert(old, at(1))
    with monkeypatch.context() as m:
        m.setattr(lake, "_write", die)
        with pytest.raises(RuntimeError):
            lake.upsert(new, at(2))
    again = LakeTable(lake.spark, lake.path, keys=["id"], partition_by=["grp"])
    assert as_set(again.read()) == as_set(old) and again.feed(0).isEmpty()
    assert again.upsert(new, at(2)) == 1
    assert as_set(again.read()) == as_set(ch.merge_upsert(old, new, ["id"]))


def test_lake_finishes_what_a_dead_run_staged(lake, spark, old, new, tmp_path, monkeypatch):
    """It dies while buckets are replaced, some of them gone already; whoever comes next replaces them again, once."""
    lake.upsert(old, at(1))
    with monkeypatch.context() as m:
        m.setattr(lake, "_replace", die)
        with pytest.raises(RuntimeError):
            lake.upsert(new, at(2))
    for f in list((tmp_path / "t/data").rglob("*.parquet"))[:2]:
        staged = tmp_path / "t/staged/version-1" / f.parent.name
        if staged.exists():
            f.rename(f.with_suffix(".lost"))
    again = LakeTable(spark, lake.path, keys=["id"], partition_by=["grp"])
    assert as_set(again.read()) == as_set(ch.merge_upsert(old, new, ["id"])) and again.version() == 1
    assert as_set(again.read(0)) == as_set(old) and again.feed(0).count() == 5
    assert again.upsert(new, at(3)) == 1
    assert not list((tmp_path / "t/staged").glob("*"))


def test_undo_changes_gives_back_every_state(spark):
    states = [
        spark.createDataFrame(rows, SCHEMA)
        for rows in ([(1, "a", 1.0), (2, "b", 2.0)], [(2, "b", 5.0), (3, "c", 3.0)], [(1, "z", 9.0), (2, "b", 6.0)], [(4, "d", 4.0)])
    ]
    feeds = [ch.change_feed(a, b, ["id"], v) for v, (a, b) in enumerate(zip(states, states[1:]), 1)]
    for v in range(3):
        later = feeds[v]
        for f in feeds[v + 1 :]:
            later = later.unionByName(f)
        assert as_set(ch.undo_changes(states[-1], later, ["id"])) == as_set(states[v])


def test_lake_partition_values_with_odd_characters(spark, tmp_path):
    lake = LakeTable(spark, str(tmp_path / "t"), keys=["id"], partition_by=["grp"])
    odd = [(1, "EPS Sanitas"), (2, "a/b=c"), (3, "50% + x"), (4, "ñ [1] {2}*"), (5, None)]
    lake.upsert(spark.createDataFrame(odd, "id bigint, grp string"), at(1))
    lake.upsert(spark.createDataFrame([(1, "EPS Sanitas 2"), (2, "a/b=c2"), (3, "50%"), (4, "ñ")], "id bigint, grp string"), at(2))
    assert {r.id: r.grp for r in lake.read().collect()} == {
        1: "EPS Sanitas 2", 2: "a/b=c2", 3: "50%", 4: "ñ", 5: None,
    }


def test_lake_schema_evolution(lake, spark, old):
    lake.upsert(old, at(1))
    lake.upsert(spark.createDataFrame([(1, "a", 1.0, "x")], SCHEMA + ", extra string"), at(2))
    lake.upsert(spark.createDataFrame([(2, "a", 2.5)], SCHEMA), at(3))
    got = {r.id: (r.v, r.extra) for r in lake.read().collect() if r.id in (1, 2, 5)}
    assert got == {1: (1.0, "x"), 2: (2.5, None), 5: (5.0, None)}


def test_append_once_per_tag(spark, tmp_path, old):
    log = LakeTable(spark, str(tmp_path / "log"), schema=old.schema)
    assert log.read().isEmpty() and log.read().schema == old.schema
    log.append(old, at(1), tag="batch-0", once=True)
    log.append(old, at(2), tag="batch-0", once=True)
    assert log.read().count() == len(OLD) and log.version() == 0
    log.append(old.filter("id = 1"), at(3), kind="overwrite")
    assert log.read().count() == 1 and log.read(0).count() == len(OLD)
    assert {r["_change_type"] for r in log.feed().collect()} == {"insert"}
