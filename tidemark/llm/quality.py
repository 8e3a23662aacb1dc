"""Quality of documents: hierarchical empirical Bayes over hosts and paths.

Boosted trees over surface features, calibrated, give each document its own evidence. Sums of these by host and by path
below the host are grouped aggregates, which each task first takes on its own, so a host with a third of all rows is a
few numbers. A host's rate of good documents is shrunk towards the global rate, and a path's towards its host's, the more
the fewer documents it has; how strongly follows from how much hosts, and paths within hosts, differ beyond chance
(moments of the grouped rates). A document's score moves its evidence from the global prior to its path's posterior.

``documents`` have no address: the host is ``source`` and the path ``lang``. Null hosts and paths are a host and a path of
their own. A null text is empty. Without usable labels all evidence is nought, so every score is 0.5 and all stay.
Repeated rows get the same score. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.features import repetition, surface
from tidemark.llm.frames import KEY, keyed, on_file, small, staged
from tidemark.llm.labelled import SAMPLE, sample
from tidemark.llm.trees import calibrated

#: Documents with a lower probability of being good are rejected.
THRESHOLD = 0.5
#: No group moves a document's log-odds by more than this.
SHIFT = 2.0
EDGE = 1e-4


def _matrix(column) -> np.ndarray:
    data, offsets = tokens.text_bytes(column)
    begins, ends, at = tokens.spans(data, offsets)
    columns = surface(data, offsets, begins, ends, at) | repetition(tokens.word_hashes(data, begins), at)
    return np.column_stack(list(columns.values())).astype(float)


def _features(batches):
    for batch in batches:
        for piece in tokens.pieces(batch):
            rows = pa.array(list(_matrix(piece.column("text"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("y"), rows], ["doc_id", "y", "x"])


def _evidence(sent):
    def run(batches):
        trees, curve = sent.value
        for batch in batches:
            for piece in tokens.pieces(batch):
                p = curve(trees.logit(_matrix(piece.column("text")))) if trees else np.full(piece.num_rows, 0.5)
                columns = [*[piece.column(c) for c in (*KEY, "doc_id", "host", "path")], pa.array(p)]
                yield pa.RecordBatch.from_arrays(columns, [*KEY, "doc_id", "host", "path", "evidence"])

    return run


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE):
    """Trees and curve, or two times None without labels of both kinds."""
    known = sample(docs, labels, "quality", rows)
    found = known.select("doc_id", "y", "text").mapInArrow(_features, "doc_id long, y int, x array<double>").toArrow()
    found = found.take(np.lexsort((found["y"].to_numpy(), found["doc_id"].to_numpy())))
    y = (found["y"].to_numpy() > 0).astype(float)
    return calibrated(np.array(found["x"].to_pylist(), float), y) if len(np.unique(y)) == 2 else (None, None)


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, centre: Column) -> float:
    """How many documents the prior counts for: from the variance of group rates around their centre beyond chance."""
    chance = centre * (1 - centre) / F.col("n")
    found = groups.agg(
        F.sum(F.col("n") * (F.pow(F.col("good") / F.col("n") - centre, 2) - chance)).alias("over"), F.sum("n").alias("n"),
        F.sum(F.col("n") * centre * (1 - centre)).alias("spread"),
    ).first()
    over, spread = ((found[k] or 0) / (found["n"] or 1) for k in ("over", "spread"))
    return min(max(spread / over - 1, 1.0), 1e6) if over > 0 else 1e6


def posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """host, path, host_rate and path_rate of every path, from rows with host, path and evidence; and the global rate."""
    paths = staged(evidence.groupBy("host", "path").agg(F.sum("evidence").alias("good"), F.count(F.lit(1)).alias("n")), "paths")
    hosts = staged(paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "hosts")
    total = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    rate = (total["good"] or 0.0) / total["n"] if total["n"] else 0.5
    weight = _strength(hosts, F.lit(rate))
    hosts = staged(hosts.withColumn("host_rate", (F.col("good") + weight * rate) / (F.col("n") + weight)), "host-rates")
    below = paths.join(hosts.select(F.col("host").alias("of"), "host_rate"), F.col("host").eqNullSafe(F.col("of"))).drop("of")
    weight = _strength(below, F.col("host_rate"))
    return staged(below.select("host", "path", "host_rate", ((F.col("good") + weight * F.col("host_rate")) / (F.col("n") + weight)).alias("path_rate")), "path-rates"), rate


def quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", rows: int = SAMPLE) -> DataFrame:
    """A row per document: KEY, doc_id, host, path, evidence, host_rate, path_rate, score, kept."""
    docs = on_file(docs)
    own = keyed(docs, "doc_id", host, path, "text").toDF(*KEY, "doc_id", "host", "path", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    own = own.withColumns({c: F.col(c).cast("string") for c in ("host", "path")})
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    form = "at_file long, at_row long, doc_id long, host string, path string, evidence double"
    found = staged(own.mapInArrow(_evidence(sent), form), "evidence")
    rates, rate = posteriors(found)
    rates = small(rates.withColumnsRenamed({"host": "of_host", "path": "of_path"}), 128)
    shift = _logit(F.col("path_rate")) - _logit(F.lit(rate))
    moved = _logit(F.col("evidence")) + F.least(F.greatest(shift, F.lit(-SHIFT)), F.lit(SHIFT))
    joined = found.join(rates, F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path")))
    scored = joined.withColumn("score", 1 / (1 + F.exp(-moved)))
    return scored.select(*KEY, "doc_id", "host", "path", "evidence", "host_rate", "path_rate", "score", (F.col("score") >= THRESHOLD).alias("kept"))
