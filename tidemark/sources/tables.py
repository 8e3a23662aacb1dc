"""Tables of a lakehouse as plain Parquet folders: append-only with loads, or keyed with upserts, both with a change feed.

* ``changes/_commit_version=N``: what version N inserted, changed and deleted (of an append-only table: its rows),
* ``data/_bucket=B``: a keyed table's rows as they are now, dealt by a hash of the key,
* ``versions``: small rows that say how far each version got, like the control tables of watermarks and ledgers.

An upsert writes its changes, then new copies of the buckets that hold any beside the table, and says so (``staged``). Only then
are these buckets replaced, by Spark's dynamic partition overwrite, and the version is ``done``. A run that dies before the first
mark has changed nothing that anybody sees, and the next one writes the same folders again; if it dies between the two marks,
whoever opens the table next replaces the buckets again from the copies. Each table has one writer at a time.

Nothing about files is kept or collected: buckets are listed by number, and there are ``buckets`` of them however long the
table lives. Older states come from the feed, by undoing it.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import _differs, assert_unique, undo_changes
from tidemark.operators.incremental import CURRENT_KINDS
from tidemark.operators.joins import matching, merged_if_many
from tidemark.session import one_row
from tidemark.sources.files import nullable, read_or_empty, remove_folder, write_partitioned

#: Buckets of a new keyed table. Each should be a few hundred megabytes in the end: a table of 100 TB wants many thousands.
BUCKETS = 8
VERSION_SCHEMA = (
    "version bigint, committed_at timestamp, kind string, state string, schema string, tag string, buckets int"
)
FEED_FIELDS = [
    T.StructField("_change_type", T.StringType()),
    T.StructField("_commit_timestamp", T.TimestampType()),
    T.StructField("_commit_version", T.LongType()),
]
STORED = [T.StructField("_gone", T.BooleanType()), T.StructField("_bucket", T.IntegerType())]


def _from_json(schema: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(schema))


class LakeTable:
    """A versioned table. With ``keys`` it is upserted, without it is append-only.

    ``partition_by`` partitions what an append-only table is sent, and orders the rows within a keyed table's buckets, so that
    Parquet statistics can skip row groups. ``buckets`` only counts when a table is new.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType | None = None,
        keys: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        ignore: Sequence[str] = (),
        shape: T.StructType | None = None,
        buckets: int = BUCKETS,
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.declared = nullable(schema) if schema is not None else None
        self.keys, self.partition_by, self.ignore = list(keys), list(partition_by), list(ignore)
        # What a table that was never written looks like to its readers; the first rows still bring their own types.
        self.shape = nullable(shape) if shape is not None else None
        self._fresh_buckets, self._known = buckets, None

    # ---- how far the table is -----------------------------------------------------------------------------------

    def versions(self) -> DataFrame:
        """One row per version and state it reached."""
        return read_or_empty(self.spark, f"{self.path}/versions", VERSION_SCHEMA)

    def _newest(self) -> Row | None:
        """The newest version, or None. Read once per object, as a table has one writer. What a dead run had staged is
        finished first."""
        if self._known is None:
            self._known = [self._read_newest()]
            newest = self._known[0]
            if newest is not None and not newest["done"]:
                self._replace(newest)
        return self._known[0]

    def _read_newest(self) -> Row | None:
        done = (F.col("state") == "done").alias("done")
        last = F.max(F.struct("version", done, "committed_at", "kind", "schema", "tag", "buckets")).alias("last")
        whole = F.max(F.when(F.col("kind") == "overwrite", F.col("version"))).alias("whole")
        row = self.versions().agg(last, whole).select("last.*", "whole").first()
        return row if row["version"] is not None else None

    def version(self) -> int:
        """The newest version, -1 before the first commit."""
        newest = self._newest()
        return -1 if newest is None else newest["version"]

    def has_tag(self, tag: str) -> bool:
        return not self.versions().filter((F.col("tag") == tag) & (F.col("state") == "done")).isEmpty()

    def tag(self) -> str | None:
        """The newest version's tag."""
        newest = self._newest()
        return newest["tag"] if newest else None

    def exists(self) -> bool:
        return self._newest() is not None

    def _note(self, version: int, at, kind: str, schema: str, tag: str | None, state: str = "done") -> int:
        """Say how far a version got; and know it, as nobody else writes."""
        buckets, before = self.buckets, self._known[0] if self._known else None
        row = (version, at, kind, state, schema, tag, buckets)
        one_row(self.spark, VERSION_SCHEMA, row).write.mode("append").parquet(f"{self.path}/versions")
        whole = version if kind == "overwrite" else before["whole"] if before is not None else None
        named = {"version": version, "done": state == "done", "committed_at": at, "kind": kind, "schema": schema, "tag": tag}
        self._known = [Row(**named, buckets=buckets, whole=whole)]
        return version

    @property
    def buckets(self) -> int:
        newest = self._known[0] if self._known else None
        return self._fresh_buckets if newest is None else newest["buckets"]

    def _schema(self) -> T.StructType | None:
        newest = self._newest()
        return _from_json(newest["schema"]) if newest is not None else self.declared

    def _known_schema(self) -> T.StructType:
        schema = self._schema() or self.shape
        if schema is None:
            raise ValueError(f"{self.path} has no commit and no declared schema")
        return schema

    # ---- reading ------------------------------------------------------------------------------------------------

    def _rows(self, schema: T.StructType, buckets: Sequence[int] | None = None) -> DataFrame:
        """A keyed table's rows with their bucket; only the folders of ``buckets`` are read."""
        stored = T.StructType([*schema.fields, *STORED])
        if self.version() < 0:
            return self.spark.createDataFrame([], stored).drop("_gone")
        rows = read_or_empty(self.spark, f"{self.path}/data", stored)
        if buckets is not None and len(buckets) < self.buckets:
            rows = rows.filter(F.col("_bucket").isin(*buckets))
        return rows.filter(~F.col("_gone")).drop("_gone")

    def _bucket(self, schema: T.StructType) -> Column:
        """Where a key's row is, whatever type the key has in the frame at hand."""
        return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _buckets_of(self, df: DataFrame, schema: T.StructType) -> list[int]:
        """The buckets a frame's keys are in: a list no longer than the number of buckets."""
        return sorted(r[0] for r in df.select(self._bucket(schema).alias("b")).distinct().collect())

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of ``version`` (default: now). A table never written is empty but has its declared schema."""
        schema = self._known_schema()
        if not self.keys:
            last = self.version() if version is None else min(version, self.version())
            newest = self._newest()
            first = 0 if newest is None or newest["whole"] is None else newest["whole"]
            if first > last:
                whole = (F.col("kind") == "overwrite") & (F.col("version") <= last)
                first = self.versions().filter(whole).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
            return self.feed(first - 1).filter(F.col("_commit_version") <= last).select(*schema.names)
        rows = self._rows(schema).select(*schema.names)
        if version is None or version >= self.version():
            return rows
        return undo_changes(rows, self.feed(version), self.keys)

    def matching(self, keys: DataFrame, on: Sequence[str]) -> DataFrame:
        """Rows whose ``on`` columns appear in ``keys``, null matching null. If these are the table's keys, only the buckets
        that can hold any are read.

        ``keys`` is read twice, so hand over a written table or something as cheap.
        """
        schema = self._known_schema()
        exact = set(on) == set(self.keys) and self.exists()
        rows = self._rows(schema, self._buckets_of(keys, schema) if exact else None)
        return matching(rows, keys, on).select(*schema.names)

    def feed(self, since: int = -1) -> DataFrame:
        """The change feed after version ``since``: the table's columns, ``_change_type``, ``_commit_version`` and
        ``_commit_timestamp``. Only the folders of newer versions are read."""
        schema = self._known_schema()
        full = T.StructType([*schema.fields, *FEED_FIELDS])
        columns = [*schema.names, "_change_type", "_commit_version", "_commit_timestamp"]
        rows = read_or_empty(self.spark, f"{self.path}/changes", full)
        return rows.filter(F.col("_commit_version").between(since + 1, self.version())).select(*columns)

    # ---- writing ------------------------------------------------------------------------------------------------

    def _evolve(self, incoming: T.StructType) -> T.StructType:
        """Known columns in their order and type, then new ones."""
        known = self._schema()
        if known is None:
            return nullable(incoming)
        new = [f for f in nullable(incoming).fields if f.name not in known.names]
        return T.StructType([*known.fields, *new])

    def _cast(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        have = set(df.columns)
        return df.select(
            *[
                (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields
            ]
        )

    def append(
        self, df: DataFrame, at: datetime, kind: str = "append", tag: str | None = None, once: bool = False
    ) -> int:
        """Add rows (``kind="overwrite"``: replace all rows). With ``once``, a ``tag`` that was committed before
        means the batch is a replay, and nothing is written. Returns the newest version."""
        if self.keys:
            raise ValueError("a keyed table is written with upsert")
        if once and tag is not None and self.has_tag(tag):
            return self.version()
        return self.append_counted(df, at, kind, tag)[0]

    def append_counted(
        self, df: DataFrame, at: datetime, kind: str = "append", tag: str | None = None, counts: Mapping[str, Column] | None = None
    ) -> tuple[int, dict]:
        """(the newest version, ``counts`` of the rows, taken while they are written). With a count ``n`` of 0 there is no new
        version."""
        version, schema = self.version() + 1, self._evolve(df.schema)
        rows = self._cast(df, schema).withColumns(
            {"_change_type": F.lit("insert"), "_commit_timestamp": F.lit(at).cast("timestamp")}
        )
        path = f"{self.path}/changes/_commit_version={version}"
        found = write_partitioned(rows, path, self.partition_by, "overwrite", counts)
        if counts and not found["n"]:
            return version - 1, found
        return self._note(version, at, kind, schema.json(), tag), found

    def upsert(
        self, df: DataFrame, at: datetime, tag: str | None = None, scope: DataFrame | None = None, unique: bool = False
    ) -> int:
        """Merge ``df`` (one row per key) into the table. Rows equal to what is there are left alone; if all are, no
        version is made. Returns the newest version.

        ``scope`` holds keys that were computed anew: those of them that ``df`` does not have are deleted. ``df`` and
        ``scope`` are read more than once, so hand over written tables or something as cheap. Say ``unique`` if ``df`` is
        known to have each key once, and none that is null.
        """
        if not unique:
            assert_unique(df, self.keys)
        version, schema = self.version() + 1, self._evolve(df.schema)
        source = self._cast(df, schema)
        path = f"{self.path}/changes/_commit_version={version}"
        seen = Observation()
        changed = self._changed(source, schema, at, scope).observe(seen, F.count(F.lit(1)).alias("n"))
        changed.write.mode("overwrite").parquet(path)
        n = seen.get.get("n")
        if not n:
            # A table that gets its first, empty, load exists from then on, with its schema.
            return version - 1 if version else self._note(version, at, "upsert", schema.json(), tag)
        feed = self.spark.read.schema(T.StructType([*schema.fields, *FEED_FIELDS[:-1]])).parquet(path)
        images = feed.filter(F.col("_change_type").isin(*CURRENT_KINDS)).select(*schema.names)
        rows = images.withColumns({"_gone": F.lit(False), "_bucket": self._bucket(schema)})
        if version == 0:
            self._write(rows, f"{self.path}/data")
            return self._note(version, at, "upsert", schema.json(), tag)
        old = self._rows(schema, self._buckets_of(feed, schema))
        kept = old.join(merged_if_many(feed.select(*self.keys), n), self.keys, "left_anti").withColumn("_gone", F.lit(False))
        # A bucket is replaced by what is written for it, so one that lost its last row must still have something.
        gone = feed.filter(F.col("_change_type") == "delete").select(*schema.names)
        marks = gone.withColumns({"_gone": F.lit(True), "_bucket": self._bucket(schema)})
        self._write(rows.unionByName(kept).unionByName(marks), self._staged(version))
        self._note(version, at, "upsert", schema.json(), tag, "staged")
        self._replace(self._known[0])
        return version

    def _staged(self, version: int) -> str:
        return f"{self.path}/staged/version-{version}"

    def _write(self, rows: DataFrame, path: str) -> None:
        """Rows by bucket; AQE splits a bucket that is too large for one task."""
        spread = rows.hint("rebalance", F.col("_bucket")).sortWithinPartitions("_bucket", *self.partition_by)
        spread.write.partitionBy("_bucket").mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    def _replace(self, staged: Row) -> None:
        """Put the staged copies in the place of their buckets. Done twice, it comes to the same."""
        schema, path = _from_json(staged["schema"]), self._staged(staged["version"])
        copies = self.spark.read.schema(T.StructType([*schema.fields, *STORED])).parquet(path)
        writer = copies.sortWithinPartitions("_bucket", *self.partition_by).write.partitionBy("_bucket").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/data")
        self._note(*(staged[c] for c in ("version", "committed_at", "kind", "schema", "tag")))
        remove_folder(self.spark, path)

    def _changed(self, source: DataFrame, schema: T.StructType, at: datetime, scope: DataFrame | None) -> DataFrame:
        """Feed rows that bring the table to ``source``."""
        stamp = F.lit(at).cast("timestamp")
        if self.version() < 0:
            return source.withColumns({"_change_type": F.lit("insert"), "_commit_timestamp": stamp})
        after = source.select(*self.keys, F.struct(*schema.names).alias("after"))
        if scope is not None:
            computed = scope.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in self.keys]).distinct()
            empty = computed.join(source.select(*self.keys), self.keys, "left_anti")
            after = after.unionByName(empty.withColumn("after", F.lit(None).cast(after.schema["after"].dataType)))
        held = self._rows(schema, self._buckets_of(after, schema)).select(*self.keys, F.struct(*schema.names).alias("before"))
        pairs = after.join(held, self.keys, "left")
        known, wanted = F.col("before").isNotNull(), F.col("after").isNotNull()
        compared = [c for c in schema.names if c not in self.keys and c not in self.ignore]

        def image(kind: str, row: str) -> Column:
            return F.struct(F.col(row).alias("row"), F.lit(kind).alias("kind"))

        images = (
            F.when(~known, F.array(image("insert", "after")))
            .when(~wanted, F.array(image("delete", "before")))
            .otherwise(F.array(image("update_preimage", "before"), image("update_postimage", "after")))
        )
        changed = pairs.filter((known | wanted) & (~known | ~wanted | _differs("before", "after", compared)))
        return changed.select(F.explode(images).alias("c")).select(
            "c.row.*", F.col("c.kind").alias("_change_type"), stamp.alias("_commit_timestamp")
        )
