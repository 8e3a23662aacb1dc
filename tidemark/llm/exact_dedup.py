"""Exact deduplication as a stateful stream.

``absorb`` is a streaming aggregation whose state, on disk in RocksDB and never expired, holds for each digest of a
normalised text how many rows had it, the identifier of the row that stays and the locator of its content (file and row).
Later arrivals continue from the same folder. ``dedup`` streams a table's fingerprints through it, reads the state, and
checks the full bytes of every hit: where texts under one digest differ, they are grouped anew by the text itself.

Only narrow rows are shuffled; texts are read once for their fingerprints and, for rows that share a digest, once more for
the check, in which the copies of a text meet as a minimum and a maximum that each task first takes on its own. A digest
with a third of all rows is thus one state row and a few texts; Spark splits it where rows take their labels.

Texts are equal when they are identical without ASCII white space; null counts as empty. Of equal texts the row with most
code points stays, then the smallest doc_id (nulls last), then the first in the input; so of repeated rows one stays.
Empty tables give empty results. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import KEY, keyed, on_file, small, staged
from tidemark.session import work_dir

SPACE = " \t\n\x0b\x0c\r"
BATCH_BYTES = 64 << 30
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
FEED = "at_file long, at_row long, doc_id long, n_chars long, sha binary, digest binary"


def normal(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def fingerprints(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """Of a table or a stream of files: KEY, doc_id, code points, SHA-256, and the digest (its first bytes)."""
    rows = keyed(docs, "doc_id", "text")
    sha = F.unhex(F.sha2(normal(F.col("text")).cast("binary"), 256))
    rows = rows.select(*KEY, F.col("doc_id").cast("long"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), sha.alias("sha"))
    return rows.withColumn("digest", F.substring("sha", 1, digest_bytes))


def _rank() -> Column:
    """Greatest for the row that stays. ``~x`` turns the order of whole numbers round without overflow."""
    turned = [F.bitwise_not(c).alias(c) for c in ("doc_id", *KEY)]
    return F.struct("n_chars", F.col("doc_id").isNotNull().alias("has_id"), *turned)


def absorb(stream: DataFrame, state: str) -> DataFrame:
    """Take in what a stream of fingerprints holds now; the state of all that was ever taken in, a row per digest."""
    spark = stream.sparkSession
    held = stream.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(_rank()).alias("best"))
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    try:
        for k, v in ROCKSDB.items():
            spark.conf.set(k, v)
        run = held.writeStream.outputMode("update").format("noop").option("checkpointLocation", state).trigger(availableNow=True)
        run.start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    rows = spark.read.format("statestore").load(state)
    value = rows.schema["value"].dataType.names
    return rows.select("key.digest", F.col("value")[value[0]].alias("group_size"), F.col("value")[value[1]].alias("best"))


def dedup(docs: DataFrame, digest_bytes: int = 32, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """A row per document: KEY, doc_id, keep_id, group_size, kept, text_sha256."""
    spark, docs = docs.sparkSession, on_file(docs)
    feed_path = work_dir(spark, "fingerprints")
    fingerprints(docs, digest_bytes).write.parquet(feed_path)
    feed = spark.read.schema(FEED).parquet(feed_path)
    if not feed.head(1):
        return _labels(feed.withColumns({"group_size": F.lit(0).cast("long"), "best": _rank()}))
    stream = spark.readStream.schema(FEED).option("maxBytesPerTrigger", batch_bytes).parquet(feed_path)
    state = absorb(stream, work_dir(spark, "dedup-state"))
    rows = staged(feed.join(state, "digest"), "dedup")
    hits = rows.where("group_size > 1")
    texts = keyed(docs, "text").join(small(hits.select(*KEY, "digest"), 96), KEY).select("digest", normal(F.col("text")).alias("text"))
    checked = texts.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    clash = staged(checked.where("low != high").select("digest"), "clashes")
    if not clash.head(1):
        return _labels(rows)
    return _labels(rows.join(clash, "digest", "left_anti").unionByName(_by_text(docs, rows.join(clash, "digest", "left_semi"))))


def _by_text(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows whose digest several texts share, grouped by the texts."""
    full = rows.drop("group_size", "best").join(keyed(docs, "text").withColumn("text", normal(F.col("text"))), KEY)
    groups = full.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("group_size"), F.max(_rank()).alias("best"))
    return full.join(groups, ["digest", "text"]).select(rows.columns)


def _labels(rows: DataFrame) -> DataFrame:
    best = {c: F.bitwise_not(F.col("best")[c]) for c in ("doc_id", *KEY)}
    kept = (best[KEY[0]] == F.col(KEY[0])) & (best[KEY[1]] == F.col(KEY[1]))
    sha = F.lower(F.hex("sha"))
    return rows.select(*KEY, "doc_id", best["doc_id"].alias("keep_id"), "group_size", kept.alias("kept"), sha.alias("text_sha256"))
