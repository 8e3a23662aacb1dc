"""Relational source and sink over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BATCH_SIZE = 10_000


def incremental_query(
    table: str, column: str | None = None, since: datetime | None = None, stamp_type: str = "TIMESTAMP"
) -> str:
    """The query the database runs: rows from ``since`` on (cut to the second), or all of them without a watermark. Rows
    with the very stamp of the watermark come again and are told by their keys; rows without a stamp come too, once a run.
    ``stamp_type`` is the database's name for a timestamp, ``DATETIME`` for some."""
    if column is None or since is None:
        return f"SELECT * FROM {table}"
    return f"SELECT * FROM {table} WHERE CAST({column} AS {stamp_type}) >= '{since:%Y-%m-%d %H:%M:%S}' OR {column} IS NULL"


def key_offsets_query(tables: Mapping[str, str]) -> str:
    """One query for the largest key of each table (table -> key), 0 for an empty one."""
    return " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, COALESCE(MAX({k}), 0) AS max_id FROM {t}" for t, k in tables.items()
    )


def row_count_query(table: str) -> str:
    """Counting is left to the database."""
    return f"SELECT COUNT(1) AS filas FROM {table}"


def read_jdbc_incremental(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    since: datetime | None = None,
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
    stamp_type: str = "TIMESTAMP",
) -> DataFrame:
    """Read new rows; the database filters. ``split`` is (numeric column, lower, upper, partitions): the bounds only
    shape the parallel reads, rows outside them are still read."""
    query = incremental_query(table, column, since, stamp_type)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) t").options(**(options or {}))
    if split:
        key, low, high, n = split
        reader = reader.options(partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=n)
    if schema is not None:
        reader = reader.option("customSchema", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema))
    return reader.load()


def write_jdbc(
    df: DataFrame, url: str, table: str, batch_size: int = BATCH_SIZE, options: Mapping[str, str] | None = None
) -> None:
    """Append to a relational table."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    writer.options(**(options or {})).mode("append").save()
