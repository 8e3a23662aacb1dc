"""Streams with an event-time watermark: copies are dropped with bounded state, and what comes too late is kept apart.

Spark drops rows behind a stream's watermark without a trace. So a first query splits each micro-batch by a mark of its own,
the greatest event time of all batches before less ``delay``, and a second one, with ``withWatermark`` and
``dropDuplicatesWithinWatermark``, only gets what is on time. It takes all that the first has written since in one batch, so its
watermark is never ahead of the mark by which a row was let through, and it drops none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import one_row
from tidemark.sources.files import nullable, read_or_empty
from tidemark.streaming.ingest import foreach_batch_sink, stream_to_parquet

MARKS = "hasta timestamp, lote bigint"
LATE, UNDATED = "FUERA_DE_MARCA", "SIN_FECHA"


def _split(batch: DataFrame, batch_id: int, event_time: str, delay: str, root: str) -> None:
    """Write a micro-batch in one pass, on time or not by folder. Done twice, it comes to the same."""
    spark = batch.sparkSession
    marks = read_or_empty(spark, f"{root}/marks", MARKS).filter(F.col("lote") < batch_id)
    mark = marks.agg(F.max("hasta") - F.expr(f"INTERVAL {delay}")).first()[0]
    behind = F.lit(False) if mark is None else F.col(event_time) < F.lit(mark)
    why = F.when(F.col(event_time).isNull(), F.lit(UNDATED)).when(behind, F.lit(LATE)).otherwise(F.lit("no"))
    seen = Observation()
    rows = batch.observe(seen, F.max(event_time).alias("hasta")).withColumn("tarde", why)
    rows.write.partitionBy("tarde").mode("overwrite").parquet(f"{root}/split/lote={batch_id}")
    last = seen.get.get("hasta")
    one_row(spark, "hasta timestamp", (last,)).write.mode("overwrite").parquet(f"{root}/marks/lote={batch_id}")


def load_on_time(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str, root: str) -> None:
    """Take all files there are. ``event_time`` is a timestamp, ``delay`` an interval such as ``2 days``.

    Of rows with equal keys whose event times are no more than ``delay`` apart, the first one stays: copies should agree. A row on
    the mark is on time. Below
    ``root`` are the rows taken (:func:`on_time`), those that came too late or have no event time (:func:`too_late`), and the
    checkpoints from which the next call goes on. A file that was taken is never read again.
    """
    spark, schema = stream.sparkSession, nullable(stream.schema)
    foreach_batch_sink(stream, lambda b, i: _split(b, i, event_time, delay, root), f"{root}/checkpoints/split")
    rows = spark.readStream.schema(schema).parquet(f"{root}/split/lote=*/tarde=no")
    # A second more: Spark drops rows that are on its watermark, and those on the mark are on time.
    unique = rows.withWatermark(event_time, f"{delay} 1 second").dropDuplicatesWithinWatermark(list(keys))
    stream_to_parquet(unique, f"{root}/taken", f"{root}/checkpoints/taken")


def on_time(spark: SparkSession, schema: T.StructType, root: str) -> DataFrame:
    """The rows taken, each once."""
    return read_or_empty(spark, f"{root}/taken", nullable(schema))


def too_late(spark: SparkSession, schema: T.StructType, root: str) -> DataFrame:
    """The rows that were not, with ``motivo_error``. Copies are all there."""
    form = T.StructType([*nullable(schema).fields, T.StructField("lote", T.LongType()), T.StructField("tarde", T.StringType())])
    rows = read_or_empty(spark, f"{root}/split", form).filter("tarde <> 'no'")
    return rows.withColumn("motivo_error", F.col("tarde")).drop("lote", "tarde")
