"""Exact distinct counts that can be merged: bitmaps of whole-number ids, kept beside a rollup.

A count of different patients per month says nothing about those of a quarter, and nothing can be added to it. A bitmap of the
ids can be joined to others: over months to quarters and years, over loads to a whole. Ids are dealt to bitmaps of 32,768
numbers each, so one group's ids are as many rows as they need, and each task marks its own before anything is shuffled.

Bitmaps only grow. Where rows are deleted or get another id, those of the groups touched are made anew from their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "_bloque", "_bits"


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The keys, the block of ids and a bitmap of those in it. Null ids count for nothing; ids must be whole numbers."""
    kind = df.schema[column].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{column} is {kind}: only whole numbers have a place in a bitmap")
    known = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).cast("bigint").alias("_id"))
    marked = known.select(*keys, F.bitmap_bucket_number("_id").alias(BLOCK), F.bitmap_bit_position("_id").alias("_at"))
    return marked.groupBy(*keys, BLOCK).agg(F.bitmap_construct_agg("_at").alias(BITS))


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps by fewer or other keys (columns of ``bitmaps``), or of several loads put together."""
    return bitmaps.groupBy(*keys, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many different ids each group of ``keys`` has."""
    return merged_bitmaps(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))
