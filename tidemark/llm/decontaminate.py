"""Benchmark decontamination with a positional inverted index that is distributed by document.

``build_index`` cuts the documents into segments and stores, for every term of a segment, its postings: the places of
the term in the segment's stream of words. A document lies in one segment, however long it is. ``find`` looks phrases up:
within each segment, it starts from a phrase's rarest term, shifts its postings by the term's place in the phrase and
intersects them with the shifted postings of the next rarest term, until none are left or all terms have been used.
With ``slop`` the terms beside one may stand up to that many words from their places, within the document (proximity); without, the
match is exact.

Nothing is shuffled but the hits. Postings stay where the documents were read, so a term in every document is spread over
all segments. The phrases are broadcast in blocks of at most ``BLOCK_BYTES`` of text, one search for each block.

Nulls and texts without words have no postings and no hits. Items without words match nothing; a null item_id can be hit
but isn't counted or listed. Repeated rows, ids and items each count as what they are: rows are told apart by their place
in the input, equal item_ids are listed once. Empty tables give empty results, and an empty benchmark no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.frames import KEY, keyed, on_file, staged

WINDOW = 13
SEGMENT_WORDS = 1 << 20
BLOCK_BYTES = 32 << 20
SHARE = 20

INDEX = (
    "segment string, at_file array<long>, at_row array<long>, doc_id array<long>, n_words array<long>, terms binary, "
    "counts binary, postings binary"
)
HITS = "segment string, ordinal int, items array<string>, begins array<int>, ends array<int>"


def _packed(postings: np.ndarray, heads: np.ndarray) -> bytes:
    """Differences within each term's list, byte plane by byte plane: mostly zeros, which the file's codec removes."""
    step = np.diff(postings, prepend=np.uint32(0))
    step[heads] = postings[heads]
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(data: bytes, heads: np.ndarray) -> np.ndarray:
    step = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel().astype(np.int64)
    total = np.cumsum(step)
    base = np.zeros(len(step), np.int64)
    base[heads[1:]] = np.diff(total[heads] - step[heads], prepend=0)[1:]
    return total - np.cumsum(base)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("segment", pa.string()), *[(c, pa.list_(pa.int64())) for c in (*KEY, "doc_id", "n_words")],
        *[(c, pa.binary()) for c in ("terms", "counts", "postings")],
    ])
    part, made = TaskContext.get().partitionId(), 0

    def segment(held):
        hashes = np.concatenate([h for h, _, _ in held])
        sizes = np.concatenate([np.diff(at) for _, at, _ in held])
        order = np.argsort(hashes, kind="stable").astype(np.uint32)
        terms, heads, counts = np.unique(hashes[order], return_index=True, return_counts=True)
        rows = [pa.concat_arrays([p.column(c) for _, _, p in held]).to_pylist() for c in (*KEY, "doc_id")]
        postings = _packed(order, heads)
        row = [f"{part}-{made}", *rows, sizes.tolist(), terms.tobytes(), counts.astype(np.int64).tobytes(), postings]
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True))], schema)

    held, n = [], 0
    for batch in batches:
        for piece in tokens.pieces(batch):
            hashes, at = tokens.words(piece.column("text"), tokens.LETTERS)
            held.append((hashes, at, piece))
            n += len(hashes)
            if n >= SEGMENT_WORDS:
                yield segment(held)
                held, n, made = [], 0, made + 1
    if held:
        yield segment(held)


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index over doc_id and text of ``docs``, one row a segment."""
    return staged(keyed(on_file(docs), "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(_segments, INDEX), "index")


def windows(benchmark: list[tuple[str | None, str | None]], size: int | None = WINDOW) -> list[tuple]:
    """(item_id, words) of every run of ``size`` words of every item; all words as one run where there are fewer."""
    hashes, at = tokens.words(pa.array([t for _, t in benchmark], pa.string()), tokens.LETTERS)
    found = {}
    for (item, _), a, b in zip(benchmark, at[:-1], at[1:], strict=True):
        own = hashes[a:b]
        for i in range(max(1, b - a - size + 1) if size and b > a else int(b > a)):
            run = own[i : i + size] if size else own
            found.setdefault((item, run.tobytes()), run)
    return [(item, run) for (item, _), run in found.items()]


class _Segment:
    def __init__(self, row: dict):
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.heads = np.cumsum(self.counts) - self.counts
        self.begins = np.concatenate(([0], np.cumsum(np.array(row["n_words"], np.int64))))
        self.places = _unpacked(row["postings"], self.heads)

    def lookup(self, terms: np.ndarray) -> np.ndarray:
        """Where each term's list is; -1 where the segment lacks it."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, at: int) -> np.ndarray:
        return self.places[self.heads[at] : self.heads[at] + self.counts[at]]

    def match(self, at: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, word after the last) of a phrase's matches; ``at``: the lists of its terms in order.

        A phrase matches where it may be laid so that one of its terms stands at its place, and each other one, in the same
        document, no more than ``slop`` words from its own. Of a match that reaches beyond its document, the words in it count.
        """
        order = np.argsort(self.counts[at], kind="stable")
        place = self.postings(at[order[0]])
        doc = np.searchsorted(self.begins, place, "right") - 1
        begin = place - order[0]
        if slop:
            laid = begin[:, None] + np.arange(-slop, slop + 1)
            doc, begin = np.unique(np.stack([np.repeat(doc, laid.shape[1]), laid.ravel()]), axis=1)
        exact = np.full(len(begin), not slop)
        for i in order if slop else order[1:]:
            if not len(begin):
                break
            have, want = self.postings(at[i]), begin + i
            low = np.searchsorted(have, np.maximum(want - slop, self.begins[doc]))
            nearest = have[np.minimum(low, len(have) - 1)]
            found = (low < len(have)) & (nearest <= want + slop) & (nearest < self.begins[doc + 1])
            if slop:
                there = np.minimum(np.searchsorted(have, want), len(have) - 1)
                exact |= (have[there] == want) & (want >= self.begins[doc]) & (want < self.begins[doc + 1])
            begin, doc, exact = begin[found], doc[found], exact[found]
        begin, doc = begin[exact], doc[exact]
        first, after = self.begins[doc], self.begins[doc + 1]
        low, high = np.maximum(begin, first) - first, np.minimum(begin + len(at), after) - first
        inside = low < high
        return doc[inside], low[inside], high[inside]


def _search(phrases, slop: int):
    schema = pa.schema([
        ("segment", pa.string()), ("ordinal", pa.int32()), ("items", pa.list_(pa.string())),
        ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
    ])

    def run(batches):
        wanted = phrases.value
        terms = np.unique(np.concatenate([w for _, w in wanted]))
        slots = [np.searchsorted(terms, w) for _, w in wanted]
        for batch in batches:
            for row in batch.to_pylist():
                held, hits = _Segment(row), {}
                at = held.lookup(terms)
                for (item, _), slot in zip(wanted, slots, strict=True):
                    own = at[slot]
                    if own.min() < 0:
                        continue
                    for d, b, e in zip(*(x.tolist() for x in held.match(own, slop)), strict=True):
                        items, begins, ends = hits.setdefault(d, (set(), [], []))
                        items.add(item)
                        begins.append(b)
                        ends.append(e)
                found = [
                    {"segment": row["segment"], "ordinal": d, "items": sorted(x for x in i if x is not None), "begins": b, "ends": e}
                    for d, (i, b, e) in sorted(hits.items())
                ]
                yield pa.RecordBatch.from_pylist(found, schema)

    return run


def find(index: DataFrame, phrases: list[tuple], slop: int = 0) -> DataFrame:
    """Matches of (item_id, words) in a stored index, a row for each document with any: items, begins and ends in words."""
    spark = index.sparkSession
    if not phrases:
        return spark.createDataFrame([], HITS)
    sent = spark.sparkContext.broadcast(phrases)
    columns = ["segment", "n_words", "terms", "counts", "postings"]
    return index.select(*columns).mapInArrow(_search(sent, slop), HITS)


def blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """(item_id as text, text) of the benchmark, in lists of about ``BLOCK_BYTES``."""
    own = benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), benchmark["text"].alias("text"))
    n = -(-(own.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES) or 1
    for b in range(n):
        block = own if n == 1 else own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [tuple(r) for r in block.collect()]


def _judged(batches):
    for batch in batches:
        n_hit, shas, counts = [], [], []
        for items, begins, ends in zip(*(batch.column(c).to_pylist() for c in ("items", "begins", "ends")), strict=True):
            covered, reach = 0, 0
            for b, e in sorted(zip(sum(begins or [], []), sum(ends or [], []), strict=True)):
                covered += max(0, e - max(b, reach))
                reach = max(reach, e)
            names = sorted({i for own in items or [] for i in own})
            n_hit.append(covered)
            counts.append(len(names))
            shas.append(hashlib.sha256(",".join(names).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in (*KEY, "doc_id", "n_words")], pa.array(n_hit, pa.int64()), pa.array(counts, pa.int64()), pa.array(shas, pa.string())],
            [*KEY, "doc_id", "n_words", "n_hit", "n_items", "items_sha256"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document: KEY, doc_id, n_words, n_hit, n_items, items_sha256, contaminated (n_hit is 5 % or more)."""
    index = build_index(docs)
    found = None
    for block in blocks(benchmark):
        part = find(index, windows(block))
        found = part if found is None else found.unionByName(part)
    hits = found.groupBy("segment", "ordinal").agg(*[F.collect_list(c).alias(c) for c in ("items", "begins", "ends")])
    rows = index.select("segment", F.posexplode(F.arrays_zip(*KEY, "doc_id", "n_words")).alias("ordinal", "row"))
    rows = rows.select("segment", "ordinal", *[F.col("row")[c].alias(c) for c in (*KEY, "doc_id", "n_words")])
    return (
        rows.join(hits, ["segment", "ordinal"], "left")
        .mapInArrow(_judged, "at_file long, at_row long, doc_id long, n_words long, n_hit long, n_items long, items_sha256 string")
        .withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))
    )
