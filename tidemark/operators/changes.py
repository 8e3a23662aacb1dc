"""Change sets between two states of a keyed table, and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """The rows to be merged do not have one row per key."""


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key repeats or is null. Reads the key columns only and shuffles pre-aggregated counts."""
    null_key = None
    for k in keys:
        null_key = F.col(k).isNull() if null_key is None else null_key | F.col(k).isNull()
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | null_key)
    if not bad.isEmpty():
        raise DuplicateKeyError(f"null or repeated key in {list(keys)}")


def _align(df: DataFrame, like: DataFrame) -> DataFrame:
    """Add the columns of ``like`` that ``df`` lacks, as typed nulls."""
    missing = [f for f in like.schema.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def _differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """Null-safe inequality over all columns; two NaN are equal."""
    if not columns:
        return F.lit(False)
    same = None
    for c in columns:
        eq = F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
        same = eq if same is None else same & eq
    return ~same


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], check_unique: bool = True
) -> DataFrame:
    """SQL ``MERGE`` with update-all and insert-all: rows of ``source`` replace or join those of ``target``.

    Columns only one side has are kept, filled with nulls on the other. Merging the same source again changes nothing.
    """
    if check_unique:
        assert_unique(source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def change_feed(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    version: int = 0,
    committed_at=None,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """What turned ``old`` into ``new``: insert, update_preimage, update_postimage and delete rows.

    Keys must be unique on both sides. Columns in ``ignore`` (audit stamps) do not make a row an update. A column only
    one side has is null on the other.
    """
    old, new = _align(old, new), _align(new, old)
    columns = new.columns
    compared = [c for c in columns if c not in keys and c not in ignore]
    before = old.select(*keys, F.struct(*columns).alias("before"))
    after = new.select(*keys, F.struct(*columns).alias("after"))
    pairs = before.join(after, list(keys), "full_outer")
    updated = F.col("before").isNotNull() & F.col("after").isNotNull() & _differs("before", "after", compared)
    image = lambda kind, row: F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))
    images = (
        F.when(F.col("before").isNull(), F.array(image("insert", "after")))
        .when(F.col("after").isNull(), F.array(image("delete", "before")))
        .when(updated, F.array(image("update_preimage", "before"), image("update_postimage", "after")))
    )
    changed = pairs.filter(F.col("before").isNull() | F.col("after").isNull() | updated)
    return changed.select(F.explode(images).alias("c")).select(
        "c.row.*",
        F.col("c.kind").alias("_change_type"),
        F.lit(version).cast("bigint").alias("_commit_version"),
        F.lit(committed_at).cast("timestamp").alias("_commit_timestamp"),
    )


def apply_changes(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Play one version's feed over ``target``: deleted and replaced rows go, new images come."""
    images = feed.drop("_commit_version", "_commit_timestamp")
    touched = images.filter(F.col("_change_type") != "update_preimage")
    fresh = touched.filter(F.col("_change_type") != "delete").drop("_change_type")
    kept = target.join(touched.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def undo_changes(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` as it was before the versions in ``feed``: keys these have touched get back the image their first change
    replaced, and keys that first came with them go."""
    from tidemark.operators.cleaning import dedup

    before = feed.filter(F.col("_change_type") != "update_postimage").withColumn("_oldest", -F.col("_commit_version"))
    first = dedup(before, keys, ["_oldest"])
    kept = target.join(first.select(*keys), list(keys), "left_anti")
    back = first.filter(F.col("_change_type") != "insert").select(*target.columns)
    return kept.unionByName(back)
