"""Bounded samples of labelled rows, for the classifiers that are fitted here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import KEY, keyed, on_file, small, staged

#: A classifier is fitted on about this many labelled documents at most.
SAMPLE = 20_000


def _share(rows: int, of: int, *by: str) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(1 << 30)) < int(rows / max(rows, of) * (1 << 30))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE) -> DataFrame:
    """KEY, doc_id, text and y of labelled documents; if there are more than ``rows``, a share of them by hash.

    A doc_id with several labels takes the largest; null ids and labels are left out. The bound is on documents: labels are
    cut first, and where documents share a doc_id, the documents found are cut again.
    """
    own = labels.select(labels["doc_id"].alias("doc_id"), labels[label].cast("int").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
    own = own.groupBy("doc_id").agg(F.max("y").alias("y"))
    own = staged(own.where(_share(rows, own.count(), "doc_id")), "labels-sample")
    found = keyed(on_file(docs), "doc_id", "text").join(small(own, 16), "doc_id").select(*KEY, "doc_id", "text", "y")
    # By the row's number and text, not by its file, so that the share doesn't depend on where the table lies.
    n = staged(found.select("y"), "labelled").count()
    return staged(found.where(_share(rows, n, "at_row", "doc_id", "text")), "sample")
