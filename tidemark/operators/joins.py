"""Join helpers.

No join here is forced to broadcast. Spark broadcasts a side when its size is known to be below
``spark.sql.autoBroadcastJoinThreshold`` (from file sizes, or measured by AQE at run time) and otherwise sort-merges,
where AQE splits partitions that are much larger than the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of keys that may be broadcast. Files of keys are packed so well that a few megabytes can hold millions.
FEW_ROWS = 500_000


def merged_if_many(df: DataFrame, n: int | None = None, few: int | None = None) -> DataFrame:
    """A side of a join that isn't sent through the driver if it has more than ``few`` (``FEW_ROWS``) rows, however small its files are.
    ``n`` is their number, if it is known; without it they are counted."""
    few = FEW_ROWS if few is None else few
    return df.hint("merge") if (df.count() if n is None else n) > few else df


def _spread(df: DataFrame, key: str) -> Column:
    """0, or for a null key a hash of the row's other columns, so that such rows do not meet in one task."""
    maps = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()}
    rest = [c for c in df.columns if c != key and c not in maps]
    return F.when(F.col(key).isNull(), F.xxhash64(*rest)).otherwise(F.lit(0)) if rest else F.lit(0).cast("bigint")


def lookup(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Left join of ``fact`` to ``dim`` on one key; columns of ``dim`` (without its key) are appended.

    ``dim`` must hold each key once. Rows of ``fact`` with a null key stay, match nothing, and are spread over the
    tasks.
    """
    right = dim.withColumnRenamed(dim_key or key, "_dim_key")
    # Not a plain literal: that would be folded away, and with it the second column that rows are dealt by.
    right = right.withColumn("_dim_spread", F.when(F.col("_dim_key").isNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
    left = fact.withColumn("_spread", _spread(fact, key))
    on = (left[key] == F.col("_dim_key")) & (F.col("_spread") == F.col("_dim_spread"))
    return left.join(right, on, "left").drop("_dim_key", "_dim_spread", "_spread")


def mark_known(
    fact: DataFrame, dim: DataFrame, fk: str, pk: str, flag: str, unique: bool = False
) -> DataFrame:
    """Add boolean ``flag``: whether ``fk`` has a parent. One join answers for valid and orphan rows alike."""
    parents = dim.select(F.col(pk).alias("_parent"))
    parents = parents if unique else parents.distinct()
    joined = lookup(fact, parents.withColumn("_known", F.lit(True)), fk, "_parent")
    return joined.withColumn(flag, F.coalesce("_known", F.lit(False))).drop("_known")


def matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose ``on`` columns appear in ``keys``, null matching null; never multiplies rows."""
    right = keys.select(*[F.col(c).alias(f"_k_{c}") for c in on])
    cond = [df[c].eqNullSafe(right[f"_k_{c}"]) for c in on]
    return df.join(right, cond, "left_semi")
