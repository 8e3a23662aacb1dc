"""A corpus from raw documents: good ones, each text once, one of each group of near copies, none from a benchmark, packed.

Every stage takes (session, docs, folder of tables), docs being a frame read from files, and returns a frame. All but the
last return rows of docs as they are. ``run`` writes each stage's rows as Parquet to the shared folder and reads them
again for the next.

Nulls, empty texts, repeated rows and empty tables have the results that each operator's module states. Of near copies the
one with the smallest doc_id stays (nulls last), of equal ids the one that comes first in the input; texts without words have no copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import contamination
from tidemark.llm.exact_dedup import dedup
from tidemark.llm.frames import KEY, on_file, staged, without
from tidemark.llm.near_join import near_groups
from tidemark.llm.packing import pack
from tidemark.llm.quality import quality
from tidemark.llm.queries import table


def _dropped(docs: DataFrame, gone: DataFrame, label: str) -> DataFrame:
    return without(docs, staged(gone.select(*KEY), label))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = on_file(docs)
    return _dropped(docs, quality(docs, table(spark, sf_dir, "labels")).where("NOT kept"), "poor")


def once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = on_file(docs)
    return _dropped(docs, dedup(docs).where("NOT kept"), "copies")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = on_file(docs)
    found = staged(near_groups(docs).where("n_shingles > 0"), "groups")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *KEY)
    # Rows of a group are compared with its first, a minimum that each task takes on its own before they meet.
    firsts = found.groupBy("group").agg(F.min(first).alias("first"))
    named = found.join(firsts, "group").where(first != F.col("first"))
    return _dropped(docs, named, "near-copies")


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = on_file(docs)
    return _dropped(docs, contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated"), "contaminated")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs).drop(*KEY)


STAGES = [
    ("quality", good),
    ("exact_dedup", once),
    ("near_dedup", one_of_each),
    ("decontaminate", uncontaminated),
    ("packing", packed),
]

#: The first stage's model and the third's groups of all links aren't SQL; a test holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
