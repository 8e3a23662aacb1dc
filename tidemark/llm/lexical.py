"""Ranked search with bit-sliced Bloom signatures: bounds for all documents, exact scores for those that bounds can't exclude.

**Index.** A document's signature is a Bloom filter of its terms. A term that occurs ``LEVELS[i]`` times or more is entered once
for each such level, so signatures say how often, too. Documents with about as many entries go to one segment, in which signatures
are as wide as they need; a segment is stored by slices: for each bit a bitmap over the segment's documents. The pass that
builds it also counts, exactly, the documents, their terms, and the documents that hold each of the items' terms.

**Bounds.** The slices of a term's bits, ANDed, are a bitmap of the documents that may hold it (never one too few). The weights of
an item's terms, summed over such bitmaps level by level and multiplied by what an occurrence count of that level can give at
most in a document of that length, bound the document's score from above.

**Search.** Each item's ``PROBE`` documents with the highest bounds are scored exactly; the last of the ten best of them is a score that a
result must reach. Every document whose bound reaches it is then scored exactly, and no other can be among the ten.

Items are sent to the tasks in blocks of at most ``BLOCK_BYTES`` of text. Candidates are joined to documents by broadcast below a
checked size; beyond it, documents that can't be candidates are dropped by a bitmap before texts are shuffled.

Terms are told apart by 64-bit hashes. Nulls, empty texts and texts without terms are no documents of the index and match
nothing, as do items without terms; a null doc_id comes after all others of its score, and of equal ids the first in the
input comes first. Repeated rows, ids and items each count as what they are. Texts are taken whole, however long. Empty
tables give empty results. Other columns than doc_id, text and item_id are left behind, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import tokens
from tidemark.llm.bitmap import Members, bitmap
from tidemark.llm.frames import KEY, keyed, on_file, small, staged

TOP = 10
#: Of each item so many documents with the highest bounds are scored first.
PROBE = 40
#: A term is entered once for every one of these counts that it reaches.
LEVELS = (1, 2, 3, 5, 9)
#: Signatures have so many bits for each entry (up to twice that, as widths are powers of two), and each entry sets so many.
BITS_PER_ENTRY = 8
HASHES = 3
#: Bits of a segment, all signatures together; one document may need more.
SEGMENT_BITS = 1 << 24
BLOCK_BYTES = 32 << 20
#: Bytes that a task holds of bitmaps at a time.
WORK_BYTES = 16 << 20

U64 = np.uint64
LEVEL_SALTS = [U64(i * 0x9E3779B97F4A7C15 % 2**64) for i in range(len(LEVELS))]

INDEX = "width long, at_file array<long>, at_row array<long>, doc_id array<long>, n_terms array<long>, slices binary, df binary"


# ---- index ------------------------------------------------------------------------------------------------------

def places(entries: np.ndarray, width: int) -> np.ndarray:
    """The bits of each entry in a signature of ``width`` bits: one row for each of ``HASHES``."""
    low, step = entries & U64(0xFFFFFFFF), (entries >> U64(32)) | U64(1)
    return np.stack([(low + U64(i) * step) & U64(width - 1) for i in range(HASHES)]).astype(np.int64)


def entries(terms: np.ndarray, level: int) -> np.ndarray:
    return tokens.mix(terms ^ LEVEL_SALTS[level])


class _Open:
    """A segment that is being filled."""

    def __init__(self, width: int):
        self.width, self.rows = width, []
        self.room = max(8, SEGMENT_BITS // width)
        self.slices = np.zeros((width, self.room // 8), np.uint8)

    def add(self, row: tuple, entered: np.ndarray) -> bool:
        """Take in a document; whether the segment is full now."""
        at = len(self.rows)
        self.slices[places(entered, self.width).ravel(), at >> 3] |= np.uint8(1 << (at & 7))
        self.rows.append(row)
        return len(self.rows) == self.room

    def record(self) -> pa.RecordBatch:
        used = -(-len(self.rows) // 8)
        cells = dict(zip((*KEY, "doc_id", "n_terms"), map(list, zip(*self.rows, strict=True)), strict=True))
        return pa.RecordBatch.from_pylist([cells | {"width": self.width, "slices": self.slices[:, :used].tobytes(), "df": None}], SCHEMA)


SCHEMA = pa.schema([
    ("width", pa.int64()), *[(c, pa.list_(pa.int64())) for c in (*KEY, "doc_id", "n_terms")],
    ("slices", pa.binary()), ("df", pa.binary()),
])


def _indexed(wanted):
    """Segments of a task's documents, and at its end how many of them hold each of the wanted terms."""

    def run(batches):
        terms, open_ = wanted.value, {}
        df = np.zeros(len(terms), np.int64)
        for batch in batches:
            for piece in tokens.pieces(batch):
                hashes, at = tokens.words(piece.column("text"), tokens.LETTERS)
                rows = zip(*(piece.column(c).to_pylist() for c in (*KEY, "doc_id")), strict=True)
                for row, a, b in zip(rows, at[:-1].tolist(), at[1:].tolist(), strict=True):
                    if a == b:
                        continue
                    own, counts = np.unique(hashes[a:b], return_counts=True)
                    slot = np.searchsorted(terms, own)
                    hit = terms[np.minimum(slot, len(terms) - 1)] == own
                    df[slot[hit]] += 1
                    entered = np.concatenate([entries(own[counts >= least], i) for i, least in enumerate(LEVELS)])
                    width = 1 << max(9, (BITS_PER_ENTRY * len(entered) - 1).bit_length())
                    segment = open_.get(width) or open_.setdefault(width, _Open(width))
                    if segment.add((*row, b - a), entered):
                        yield open_.pop(width).record()
        for segment in open_.values():
            yield segment.record()
        yield pa.RecordBatch.from_pylist([{"df": df.tobytes()}], SCHEMA)

    return run


def build_index(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """The stored index of ``docs``, with each task's counts of documents that hold ``terms`` (sorted)."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)
    rows = keyed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return staged(rows.mapInArrow(_indexed(sent), INDEX), "signatures")


def _summed(batches):
    """One row of counts for all of a task's."""
    total = None
    for batch in batches:
        for data in batch.column("df").to_pylist():
            own = np.frombuffer(data, np.int64)
            total = own if total is None else total + own
    if total is not None and len(total):
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "df"])


def statistics(index: DataFrame, count: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, their terms with repeats, and for each of ``count`` terms the documents that hold it."""
    held = index.where("width IS NOT NULL").select(F.explode("n_terms").alias("n")).agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(count, np.int64)
    counts = index.where("df IS NOT NULL").select("df").mapInArrow(_summed, "term long, df long")
    for term, n in counts.groupBy("term").agg(F.sum("df")).collect():
        df[term] = n
    return held[0], held[1] or 0, df


# ---- scores -----------------------------------------------------------------------------------------------------

def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


def gain(tf, n_terms, n_docs: int, n_all: int):
    """What ``tf`` occurrences give in a document of ``n_terms`` terms, before the term's weight; whole numbers throughout."""
    m = 10 + (90 * n_terms * n_docs) // n_all
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Model:
    """A block of items with the weights of their terms."""

    def __init__(self, items: list[np.ndarray], terms: np.ndarray, n_docs: int, n_all: int, weight: np.ndarray):
        self.items, self.terms, self.n_docs, self.n_all, self.weight = items, terms, n_docs, n_all, weight

    def score(self, hashes: np.ndarray, wanted: list[int]) -> list[int]:
        """Exact scores of a document's words for some items."""
        own, tf = np.unique(hashes, return_counts=True)
        slot = np.minimum(np.searchsorted(self.terms, own), len(self.terms) - 1)
        hit = self.terms[slot] == own
        value = np.zeros(len(self.terms), np.int64)
        value[slot[hit]] = self.weight[slot[hit]] * gain(tf[hit], len(hashes), self.n_docs, self.n_all)
        return [int(value[self.items[i]].sum()) for i in wanted]

    def bounds(self, width: int, n_terms: np.ndarray, slices: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each item an upper bound of every document's score."""
        used = slices.shape[1]
        step = max(1, WORK_BYTES // (HASHES * used * len(LEVELS)))
        gains = [gain(n_terms if last is None else last, n_terms, self.n_docs, self.n_all) for last in [*[x - 1 for x in LEVELS[1:]], None]]
        gains = np.diff(np.stack(gains), axis=0, prepend=0).astype(np.float64)
        some, begin = [], 0
        while begin < len(self.items):
            # As many items at a time as their terms' bitmaps have room for; an item with more terms goes alone.
            end, n = begin, 0
            while end < len(self.items) and (end == begin or n + len(self.items[end]) <= step):
                n += len(self.items[end])
                end += 1
            asked = np.unique(np.concatenate(self.items[begin:end]))
            maps = self._maps(asked, width, slices)
            for item in range(begin, end):
                at = np.searchsorted(asked, self.items[item])
                weight = self.weight[self.items[item]].astype(np.float64)
                total = np.zeros(len(n_terms))
                for level, present in enumerate(maps):
                    some = at[present[at].any(axis=1)]
                    if not len(some):
                        break
                    chosen = self.weight[asked[some]].astype(np.float64)
                    for low in range(0, len(some), 256):
                        bits = np.unpackbits(present[some[low : low + 256]], axis=1, count=len(n_terms), bitorder="little")
                        total += gains[level] * (chosen[low : low + 256] @ bits)
                # Whole numbers below 2**53, but for items of very many terms: rounded up, bounds stay bounds.
                yield item, np.where(total < 2**52, total, np.nextafter(total * (1 + 1e-12), np.inf))
            begin = end

    def _maps(self, asked: np.ndarray, width: int, slices: np.ndarray) -> list[np.ndarray]:
        """Level by level, bitmaps of the documents that may hold each of the terms so often."""
        out = []
        for level in range(len(LEVELS)):
            first, *others = places(entries(self.terms[asked], level), width)
            present = slices[first]
            for other in others:
                present &= slices[other]
            if out:
                # Who hasn't fewer occurrences hasn't more either.
                present &= out[-1]
            out.append(present)
        return out


def _segments(batches):
    for batch in batches:
        for row in batch.to_pylist():
            yield row, np.frombuffer(row["slices"], np.uint8).reshape(row["width"], -1), np.array(row["n_terms"], np.int64)


PROBED = "item int, bound double, doc_id long, at_file long, at_row long"


def _probed(sent):
    """The documents with a task's highest bounds, for each item."""

    def run(batches):
        best = {}
        for row, slices, n_terms in _segments(batches):
            for item, bound in sent.value.bounds(row["width"], n_terms, slices):
                at = np.argpartition(-bound, PROBE)[:PROBE] if len(bound) > PROBE else np.arange(len(bound))
                found = [(b, row["doc_id"][i], row[KEY[0]][i], row[KEY[1]][i]) for i, b in zip(at.tolist(), bound[at].tolist()) if b >= 1]
                best[item] = sorted(best.get(item, []) + found, key=lambda x: -x[0])[:PROBE]
        for item, rows in best.items():
            if rows:
                columns = [pa.array([item] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.float64())]
                columns += [pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "bound", "doc_id", *KEY])

    return run


CANDIDATES = "at_file long, at_row long, items array<int>"


def _reaching(sent, least):
    """Documents whose bound reaches the score that each item asks for, with these items."""

    def run(batches):
        for row, slices, n_terms in _segments(batches):
            found = {}
            for item, bound in sent.value.bounds(row["width"], n_terms, slices):
                for i in np.flatnonzero(bound >= least.value[item]).tolist():
                    found.setdefault(i, []).append(item)
            rows = [{KEY[0]: row[KEY[0]][i], KEY[1]: row[KEY[1]][i], "items": items} for i, items in found.items()]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([*[(c, pa.int64()) for c in KEY], ("items", pa.list_(pa.int32()))]))

    return run


SCORED = "item int, score long, doc_id long, at_file long, at_row long"


def _scored(sent):
    def run(batches):
        for batch in batches:
            for piece in tokens.pieces(batch):
                hashes, at = tokens.words(piece.column("text"), tokens.LETTERS)
                columns = (piece.column(c).to_pylist() for c in ("doc_id", *KEY, "items"))
                out = []
                for *row, items, a, b in zip(*columns, at[:-1], at[1:], strict=True):
                    out += [(i, s, *row) for i, s in zip(items, sent.value.score(hashes[a:b], items), strict=True) if s > 0]
                kinds = (pa.int32(), *[pa.int64()] * 4)
                arrays = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["item", "score", "doc_id", *KEY])

    return run


def _members(sent):
    """Rows whose key's hash may be among the candidates'."""

    def run(batches):
        among = Members(sent.value)
        for batch in batches:
            yield batch.filter(pa.array(among(batch.column("sign").to_numpy().view(U64))))

    return run


def _texts_of(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """KEY, doc_id, text and items of the documents that a written frame of candidates names."""
    rows = keyed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    sized = small(candidates, 48, "items")
    if sized is candidates:
        signs = candidates.select(F.xxhash64(*KEY).alias("sign"))
        sent = docs.sparkSession.sparkContext.broadcast(bitmap(signs, candidates.count(), 32))
        signed = rows.withColumn("sign", F.xxhash64(*KEY))
        rows = signed.mapInArrow(_members(sent), signed.schema).drop("sign")
    return rows.join(sized, KEY)


def _best(scored: DataFrame, order: list, most: int) -> DataFrame:
    """The first rows of each item; each task cuts its own before they are shuffled."""
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return scored.withColumn("rank", rank).where(F.col("rank") <= most)


FINAL = [F.desc, F.asc_nulls_last, F.asc, F.asc]


def _ranked(scored: DataFrame) -> DataFrame:
    return _best(scored, [how(c) for how, c in zip(FINAL, ("score", "doc_id", *KEY), strict=True)], TOP)


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """(item_id, text) of items with a text, in lists of about ``BLOCK_BYTES``."""
    own = items.select(items["item_id"].alias("item_id"), items["text"].alias("text")).where("text <> ''")
    n = -(-(own.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES) or 1
    for b in range(n):
        block = own if n == 1 else own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [tuple(r) for r in block.collect()]


def _found(docs: DataFrame, block: list[tuple]) -> tuple[DataFrame, list] | None:
    """(the best documents of each item by its number, the numbers' item_ids); None without terms or documents."""
    sc = docs.sparkSession.sparkContext
    hashes, at = tokens.words(pa.array([t for _, t in block], pa.string()), tokens.LETTERS)
    own = [(item, np.unique(hashes[a:b])) for (item, _), a, b in zip(block, at[:-1], at[1:], strict=True) if b > a]
    if not own:
        return None
    terms = np.unique(np.concatenate([t for _, t in own]))
    index = build_index(docs, terms)
    n_docs, n_all, df = statistics(index, len(terms))
    if not n_docs:
        return None
    weight = weights(df, n_docs)
    # A term that no document holds adds nothing to a score, though Bloom filters may seem to hold it.
    useful = (df > 0) & (weight > 0)
    items = [(item, slots[useful[slots]]) for item, slots in ((i, np.searchsorted(terms, t)) for i, t in own)]
    items = [(item, slots) for item, slots in items if len(slots)]
    if not items:
        return None
    sent = sc.broadcast(Model([slots for _, slots in items], terms, n_docs, n_all, weight))

    segments = index.where("width IS NOT NULL").select("width", *KEY, "doc_id", "n_terms", "slices")
    probed = segments.mapInArrow(_probed(sent), PROBED)
    probed = _best(probed, [how(c) for how, c in zip(FINAL, ("bound", "doc_id", *KEY), strict=True)], PROBE)
    probed = staged(probed.groupBy(*KEY).agg(F.collect_list("item").alias("items")), "probe")
    first = _ranked(_texts_of(docs, probed).mapInArrow(_scored(sent), SCORED))
    # Items with fewer than ten documents so far take all that may have a score.
    least = np.ones(len(items))
    for item, score in first.where(F.col("rank") == TOP).select("item", "score").collect():
        least[item] = score
    reaching = staged(segments.mapInArrow(_reaching(sent, sc.broadcast(least)), CANDIDATES), "candidates")
    return _ranked(_texts_of(docs, reaching).mapInArrow(_scored(sent), SCORED)), [item for item, _ in items]


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Each item's ten best documents with a score above 0: item_id, rank, doc_id, score and KEY of the document."""
    docs, spark = on_file(docs), docs.sparkSession
    kind = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", items.schema["item_id"].dataType)])
    found = None
    for block in _blocks(items):
        part = _found(docs, block)
        if part is None:
            continue
        # No longer than the block, whose bytes are bounded.
        names = F.broadcast(spark.createDataFrame(list(enumerate(part[1])), kind))
        named = part[0].join(names, "item").select("item_id", "rank", "doc_id", "score", *KEY)
        found = named if found is None else found.unionByName(named)
    if found is None:
        fields = [kind["item_id"], T.StructField("rank", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("doc_id", "score", *KEY)]]
        return spark.createDataFrame([], T.StructType(fields))
    return found
