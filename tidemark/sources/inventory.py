"""Counts and key offsets over a set of tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_offsets(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(tabla, max_id): the largest key of each table, 0 for an empty one. One scan of the key column each."""
    rows = [
        df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("max_id")).select(
            F.lit(name).alias("tabla"), "max_id"
        )
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def row_counts(tables: Mapping[str, DataFrame], total: str = "TOTAL") -> DataFrame:
    """(tabla, filas) per table, and a grand total."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        for name, df in tables.items()
    ]
    listed = reduce(DataFrame.unionByName, counts)
    return listed.rollup("tabla").agg(F.sum("filas").alias("filas")).withColumn(
        "tabla", F.coalesce("tabla", F.lit(total))
    )
