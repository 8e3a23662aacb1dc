"""Packing documents into length buckets with the least padding.

Documents are cut into pieces of at most ``MAX_TOKENS`` words. The histogram of the pieces' lengths, at most that many
rows whatever the input, goes to the driver, where dynamic programming finds the bucket bounds that minimise the padding
over all of the input. Inside a bucket, pieces in order of length, doc_id and place fill batches of as many rows as the
token budget holds at the bucket's length.

Batches are numbered without bringing a bucket together: pieces are range-partitioned in that order (equal lengths are
split by doc_id), each task numbers its own rows, and a small table says how many rows of the bucket stand in earlier
partitions. A bucket has at most one batch that isn't full.

A text without words, or null, has nothing to pack: it keeps one row whose bucket, batch and slot are null. Null doc_ids
come last. Repeated rows are packed as often as they occur; among equal doc_ids the place in the input decides. Empty
tables give empty results. Of equally good bounds, those with the smallest lengths are taken, from the last bucket down.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import KEY, keyed, on_file, small, staged

MAX_TOKENS = 2048
BUCKETS = 8
BATCH_TOKENS = 65_536
WORD = r"[^\x20\x09-\x0D]+"


def bounds(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """The largest lengths of the buckets that pad least, for counts by length."""
    if not histogram:
        return []
    length = np.array(sorted(histogram), np.int64)
    count = np.array([histogram[n] for n in length.tolist()], np.int64)
    rows, filled = np.concatenate(([0], np.cumsum(count))), np.concatenate(([0], np.cumsum(count * length)))
    size, never = len(length), np.iinfo(np.int64).max // 4
    # cost[i, j]: padding if lengths i to j - 1 share a bucket.
    reach = np.concatenate(([0], length))
    cost = np.where(np.tri(size + 1, dtype=bool), never, reach[None, :] * (rows[None, :] - rows[:, None]) - (filled[None, :] - filled[:, None]))
    best, back = cost[0], []
    for _ in range(min(buckets, size) - 1):
        total = best[:, None] + cost
        back.append(total.argmin(0))
        best = np.minimum(total.min(0), never)
    found, at = [], size
    for step in [*reversed(back), None]:
        found.append(int(length[at - 1]))
        at = int(step[at]) if step is not None else 0
    return found[::-1]


def pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """KEY, doc_id, piece (null without words), start and n_tokens, in words of the whole text."""
    rows = keyed(docs, "doc_id", "text").select(*KEY, "doc_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n"))
    last = F.when(F.col("n") > 0, F.floor((F.col("n") - 1) / max_tokens).cast("long"))
    cut = F.explode_outer(F.when(F.col("n") > 0, F.sequence(F.lit(0).cast("long"), last)))
    rows = rows.select(*KEY, "doc_id", "n", cut.alias("piece")).withColumn("start", F.coalesce(F.col("piece") * max_tokens, F.lit(0).cast("long")))
    return rows.withColumn("n_tokens", F.least(F.col("n") - F.col("start"), F.lit(max_tokens).cast("long"))).drop("n")


def pack(docs: DataFrame, max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """A row per piece: KEY, doc_id, piece, start, n_tokens, bucket (the padded length), batch (in its bucket) and slot."""
    order = [F.col("n_tokens"), F.col("doc_id").asc_nulls_last(), F.col("piece"), *map(F.col, KEY)]
    rows = pieces(on_file(docs), max_tokens).repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits of the number are the partition, the lower 33 the row in it.
    rows = staged(rows.withColumn("at", F.monotonically_increasing_id()), "pieces")
    counts = rows.where("piece IS NOT NULL").groupBy("n_tokens").count().collect()
    ends = bounds({r["n_tokens"]: r["count"] for r in counts}, buckets)
    bucket = F.coalesce(*[F.when((F.col("n_tokens") <= b) & F.col("piece").isNotNull(), F.lit(b)) for b in ends], F.lit(None)).cast("long")
    rows = rows.withColumn("bucket", bucket).withColumn("part", F.shiftright("at", 33))
    parts = rows.where("bucket IS NOT NULL").groupBy("bucket", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("bucket").orderBy("part")) - F.col("n")
    parts = staged(parts.select("bucket", "part", (F.col("first") - earlier).alias("zero")), "parts")
    rows = rows.join(small(parts, 32), ["bucket", "part"], "left")
    index, room = F.col("at") - F.col("zero"), F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("bucket")))
    return rows.select(
        *KEY, "doc_id", "piece", "start", "n_tokens", "bucket", F.floor(index / room).cast("long").alias("batch"), F.pmod(index, room).cast("long").alias("slot")
    )
