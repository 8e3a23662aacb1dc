"""From landing files to tables with Structured Streaming.

The checkpoint remembers which files were read, so a run only takes new ones; it is never deleted. A micro-batch that
is replayed after a failure carries the same number, and the sink recognises it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.cleaning import quarantine
from tidemark.sources import rescue
from tidemark.sources.files import conform_schema, nullable, stamp_modified, stream_files
from tidemark.sources.jdbc import write_jdbc
from tidemark.sources.tables import LakeTable
from tidemark.spec import TableSpec

INTERVAL = "5 minutes"
LOAD_SCHEMA = "tabla string, estado string, mensaje string"


def foreach_batch_sink(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool = True,
    interval: str = INTERVAL,
    name: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch that has rows to ``write(batch, batch_id)``.

    ``once`` takes all files there are, in as many batches as needed, and returns when done; otherwise the running
    query is returned, with a batch every ``interval``.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write(batch, batch_id)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    if not once:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_to_parquet(
    stream: DataFrame, path: str, checkpoint: str, parts: Sequence[str] = (), once: bool = True,
    interval: str = INTERVAL,
) -> StreamingQuery:
    """Append to Parquet with the built-in file sink, which is exactly-once by itself."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    writer = writer.partitionBy(*parts) if parts else writer
    if not once:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def conformed(batch: DataFrame, spec: TableSpec, at=None) -> DataFrame:
    """A landing batch in the table's declared types, with its modification stamp."""
    return stamp_modified(conform_schema(batch, spec.schema, spec.decimals), at, spec.watermark)


def load_to_table(
    spark: SparkSession, spec: TableSpec, folder: str, table: LakeTable, checkpoint: str, once: bool = True,
    now: Callable[[], datetime] = datetime.now, files_per_batch: int | None = None, errors: str | None = None,
) -> StreamingQuery:
    """Landing files of one table into an append-only table. A replayed batch is recognised by its tag.

    With ``errors``, the folder of an error table, CSV and JSON are read as text, and each value or record of a batch that
    can't be read becomes a row there: reason, and as payload the keys, the column and its text (but for masked
    columns). A batch that is replayed replaces what it said before. Whether there is any such value is counted while the
    batch is written, so only batches that have some are read again.
    """
    rescuing = errors is not None and spec.fmt in ("csv", "json")

    def write(batch: DataFrame, batch_id: int) -> None:
        at = now()
        tag = f"batch-{batch_id}"
        if not rescuing:
            table.append(conformed(batch, spec, at), at, tag=tag, once=True)
            return
        rows = rescue.conform_rescued(batch, spec.schema, spec.decimals)
        found = 1
        if not table.has_tag(tag):
            # Counted twice if a task is run again; all that matters is whether there are any.
            seen = Observation()
            counted = rows.observe(seen, F.count_if(rescue.rescued(rows)).alias("n"))
            table.append(stamp_modified(rescue.readable_rows(counted), at, spec.watermark), at, tag=tag)
            found = seen.get.get("n")
        if found:
            listed = rescue.rejected_values(rows, list(spec.keys), list(spec.masked))
            quarantine(listed, spec.name, at).write.mode("overwrite").parquet(f"{errors}/carga={spec.name}-{tag}")

    if rescuing:
        stream = rescue.stream_landing(spark, folder, spec.fmt, spec.schema, files_per_batch)
    else:
        stream = stream_files(spark, folder, spec.fmt, nullable(spec.schema), files_per_batch)
    return foreach_batch_sink(stream, write, checkpoint, once, name=f"load_{spec.name.lower()}")


def load_to_jdbc(
    spark: SparkSession, spec: TableSpec, folder: str, url: str, table: str, checkpoint: str, once: bool = True,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Landing files of one table into a relational table. A JDBC append is not atomic across tasks, so a batch that
    failed halfway can leave rows that its replay writes again: give the target a primary key, or read it through
    ``dedup``."""
    stream = stream_files(spark, folder, spec.fmt, nullable(spec.schema))
    return foreach_batch_sink(
        stream, lambda batch, _: write_jdbc(conformed(batch, spec), url, table, options=options), checkpoint, once
    )


def load_all(
    spark: SparkSession, specs: Sequence[TableSpec], load: Callable[[TableSpec], object]
) -> DataFrame:
    """Load tables in the given order, parents first. A table that fails is noted and the others still run; returns
    one row per table."""
    outcome = []
    for spec in specs:
        try:
            load(spec)
            outcome.append((spec.name, "OK", ""))
        except Exception as e:  # noqa: BLE001 - reported to the caller per table
            outcome.append((spec.name, "ERROR", str(e)))
    return spark.createDataFrame(outcome, LOAD_SCHEMA)
