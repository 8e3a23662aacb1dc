"""Helpers on frames that the operators share: row keys, written stages, checked broadcasts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import work_dir

#: A row's place in its file. Unlike doc_id it is never null and never repeats.
KEY = ["at_file", "at_row"]
#: A table is broadcast up to this many bytes, reckoned from its counted rows.
BROADCAST_BYTES = 32 << 20
#: Spark removes the shuffle files of what a frame's action ran as it ends, not when the driver's memory is next cleared.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which also cuts its lineage. Shuffles on the way to it leave no files."""
    spark, path = df.sparkSession, work_dir(df.sparkSession, label)
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def place(df: DataFrame) -> list[Column]:
    meta = df.metadataColumn("_metadata")
    return [F.xxhash64(meta["file_path"]).alias(KEY[0]), meta["row_index"].alias(KEY[1])]


def on_file(df: DataFrame) -> DataFrame:
    """The frame itself if its rows come straight from files, else a written copy."""
    try:
        df.select(*place(df)).schema  # noqa: B018
        return df
    except AnalysisException:
        return staged(df, "rows")


def keyed(df: DataFrame, *columns: str) -> DataFrame:
    """KEY and the columns asked for; other columns, whatever their names, are left behind."""
    return df.select(*place(df), *[df[c] for c in columns])


def small(df: DataFrame, row_bytes: int, *arrays: str) -> DataFrame:
    """A written frame, marked for broadcast if its counted rows (and entries of arrays, 8 bytes each) fit the bound; else
    joined as Spark sees fit."""
    entries = [F.sum(F.greatest(F.size(c), F.lit(0))) for c in arrays]
    n, *many = df.agg(F.count(F.lit(1)), *entries).first()
    return F.broadcast(df) if n * row_bytes + 8 * sum(m or 0 for m in many) <= BROADCAST_BYTES else df


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of docs, a frame read from files, whose KEY isn't in the written frame ``gone``."""
    return _by_key(docs, gone, "left_anti")


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs, a frame read from files, whose KEY is in the written frame ``kept``."""
    return _by_key(docs, kept, "left_semi")


def _by_key(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    inner = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *place(docs))
    return inner.join(small(keys.select(*KEY), 48), KEY, how).select("row.*")
