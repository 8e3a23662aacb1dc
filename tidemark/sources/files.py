"""File sources and sinks, batch and stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How the landing formats are laid out.
FORMAT_OPTIONS = {
    "csv": {"header": "true", "nullValue": ""},
    "json": {"multiLine": "false"},
    "parquet": {"mergeSchema": "false"},
}


def nullable(schema: T.StructType) -> T.StructType:
    """The same columns, all nullable: files promise nothing."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def read_files(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header (empty is null), JSON lines or Parquet. Give the schema: inferring it reads the data twice."""
    reader = spark.read.format(fmt).options(**FORMAT_OPTIONS.get(fmt, {}))
    return (reader.schema(schema) if schema is not None else reader).load(path)


def stream_files(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """The same as a stream that picks up new files; ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**FORMAT_OPTIONS.get(fmt, {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet table that may not have been written yet, or holds no rows: then empty, with the right schema."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def conform_schema(
    df: DataFrame, schema: T.StructType, decimals: Mapping[str, tuple[int, int]] | None = None
) -> DataFrame:
    """Cast declared columns that exist, round money to its decimal type, drop rescued data, keep other columns.

    Text that does not parse becomes null; it does not stop the load.
    """
    df = df.drop("_rescued_data")
    casts = {
        f.name: F.col(f.name).try_cast(f.dataType)
        for f in schema.fields
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    }
    for name, (precision, scale) in (decimals or {}).items():
        if name in df.columns:
            kind = schema[name].dataType if name in casts else df.schema[name].dataType
            value = F.round(casts.get(name, F.col(name)), scale)
            if isinstance(kind, T.DoubleType | T.FloatType):
                # A cast that fails throws and catches an error for each row; so what has too many digits isn't cast.
                value = F.when(F.abs(value) < 10.0 ** (precision - scale), value)
            casts[name] = value.try_cast(T.DecimalType(precision, scale))
    return df.withColumns(casts) if casts else df


def stamp_modified(df: DataFrame, at=None, column: str = "fec_modificacion") -> DataFrame:
    """Add the modification stamp: ``at``, or the time of the query."""
    return df.withColumn(column, F.current_timestamp() if at is None else F.lit(at).cast("timestamp"))


def write_partitioned(
    df: DataFrame, path: str, parts: Sequence[str] = (), mode: str = "append", counts: Mapping[str, Column] | None = None
) -> dict:
    """Partitioned Parquet. ``mode`` is append, overwrite (the whole table) or overwrite_partitions.

    Rows are first brought together by partition, so each partition gets few files; AQE splits a partition that is
    too large for one task and joins those that are small. ``counts`` are taken by the tasks that write, and returned.
    """
    if parts:
        df = df.hint("rebalance", *[F.col(c) for c in parts])
    seen = Observation()
    if counts:
        df = df.observe(seen, *[c.alias(name) for name, c in counts.items()])
    writer = df.write.partitionBy(*parts) if parts else df.write
    if mode == "overwrite_partitions":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).option("partitionOverwriteMode", "static").parquet(path)
    # Of no rows at all there may be nothing to observe.
    return {name: seen.get.get(name) for name in counts} if counts else {}


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that the library itself staged."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_landing(df: DataFrame, path: str, fmt: str, files: int | None = None) -> None:
    """Replace a landing folder. ``files`` bounds the number of files, for small tables; by default each task
    writes its own."""
    out = df.coalesce(files) if files else df
    writer = out.write.format(fmt).mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", "true").option("nullValue", "").option("emptyValue", '""')
    writer.save(path)


def read_table(
    spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A plain Parquet table of a folder of tables: ``<root>/<name>`` or ``<root>/<name>.parquet``. A known ``schema``
    saves the job that reads it from a file."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(f"{root}/{name}.parquet")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return reader.parquet(f"{root}/{name}")
