"""Threshold-scaled sketches: of a text's five-word shingles, every hash below a fixed fraction of all hashes is kept.

A sketch thus grows with its text, and two sketches say which share of one text lies in the other however unequal they are.
Texts of few shingles would often keep none; so the ``FLOOR`` smallest hashes are kept in any case. A sketch is a function of the
set of shingles alone, and so is the sketch of a union of what its parts kept: ``merge`` is exact, in any order and grouping.
What two sketches hold is compared below the lesser of the bounds up to which each is complete.

``fingerprints`` compares each document with the next one (by doc_id, nulls last, then place in the input; the first one follows
the last) and with an edited text of its own, whose last half is replaced by the beginning of the next. The rows are dealt out
by ranges of doc_id, so nearly all neighbours meet in one task; only the first and last row of each range are joined afterwards.
A range is cut anywhere between rows, also between equal ids, and is worked through in pieces of about 1 MB.

A null text is empty. A text without words has an empty sketch, which is like another empty one (1.0) and like no other (0.0); one
with fewer than five words is one shingle. Repeated rows are documents of their own, each the other's neighbour. Texts are taken
whole, however long. A single document is its own next. Empty tables give empty results; other columns than doc_id and
text are left behind, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.frames import KEY, keyed, on_file, staged

#: Hashes are kept below one in so many.
SCALE = 16
#: And so many of the smallest in any case.
FLOOR = 32
#: Bits of a hash that are kept.
BITS = 48

U64 = np.uint64
NONE = np.zeros(0, U64)
LIMIT = (1 << BITS) // SCALE


def _kept(hashes: np.ndarray) -> np.ndarray:
    return hashes[: max(int(np.searchsorted(hashes, U64(LIMIT))), FLOOR)]


def sketches(texts) -> list[np.ndarray]:
    """The sketch of each text of an Arrow column: ascending numbers of ``BITS`` bits."""
    hashes, starts = tokens.shingles(*tokens.words(texts))
    return [_kept(own) for own in tokens.distinct(hashes >> U64(64 - BITS), starts)]


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of all shingles of both texts."""
    return _kept(np.union1d(a, b))


def _reach(sketch: np.ndarray) -> int:
    """Up to which hash the sketch holds all there are."""
    return 1 << BITS if len(sketch) < FLOOR else max(int(sketch[-1]), LIMIT - 1)


def overlap(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Comparable hashes of one sketch, of the other, and of both."""
    reach = min(_reach(a), _reach(b))
    a, b = (s[: int(np.searchsorted(s, U64(reach), "right"))] for s in (a, b))
    return len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the first text's shingles that the second has; of an empty one, 1.0 if both are empty."""
    n, _, both = overlap(a, b)
    return both / n if n else float(not len(a) and not len(b))


def likeness(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """(share of the lesser text that the other has, Jaccard similarity), both estimated from sketches."""
    if not len(a) or not len(b):
        return (float(len(a) == len(b)),) * 2
    m, n, both = overlap(a, b)
    return (both / min(m, n) if m and n else 0.0), (both / (m + n - both) if m + n else 0.0)


def to_bytes(sketch: np.ndarray) -> bytes:
    """Six bytes a hash, highest first, so that equal sets of hashes give equal bytes."""
    return sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, (64 - BITS) // 8 :].tobytes()


def from_bytes(data: bytes) -> np.ndarray:
    parts = np.frombuffer(data, np.uint8).reshape(-1, BITS // 8)
    out = np.zeros((len(parts), 8), np.uint8)
    out[:, 8 - BITS // 8 :] = parts
    return out.view(">u8").ravel().astype(U64)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the other one, or all of that."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "at_file long, at_row long, doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, jaccard_edited double, jaccard_next double"
)
#: Beside results, each task gives its first and last row as they are.
MIXED = f"{RESULT}, part int, edge string, text string"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
ARROW = pa.schema([(name, _TYPES[kind]) for name, kind in (f.split(" ") for f in MIXED.split(", "))])


def _compared(rows: list[tuple], texts: list[str], following: list[str], own: list[np.ndarray], after: list[np.ndarray]):
    """Results for rows (KEY and doc_id) with their texts, the next texts, and the sketches of both."""
    made = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    changed = sketches(pa.array(made, pa.large_string()))
    near = [(*likeness(a, c), *likeness(a, b)) for a, c, b in zip(own, changed, after, strict=True)]
    columns = {
        "at_file": [r[0] for r in rows], "at_row": [r[1] for r in rows], "doc_id": [r[2] for r in rows],
        "n_chars": [len(t) for t in texts], "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in made],
        "fingerprint": [to_bytes(s) for s in own], "edited_fingerprint": [to_bytes(s) for s in changed],
        "near_edited": [n[0] for n in near], "near_next": [n[2] for n in near],
        "jaccard_edited": [n[1] for n in near], "jaccard_next": [n[3] for n in near],
    }
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(rows), f.type) for f in ARROW]
    return pa.RecordBatch.from_arrays(arrays, schema=ARROW)


def _edge(part: int, edge: str, row: tuple, text: str):
    cells = dict(zip((*KEY, "doc_id"), row, strict=True)) | {"part": part, "edge": edge, "text": text}
    return pa.RecordBatch.from_pylist([cells], ARROW)


def _along(batches):
    """Each row of a sorted part with the row after it."""
    part = TaskContext.get().partitionId()
    row, text, sketch = None, "", NONE
    for batch in batches:
        for piece in tokens.pieces(batch):
            own = sketches(piece.column("text"))
            rows = list(zip(*(piece.column(c).to_pylist() for c in (*KEY, "doc_id")), strict=True))
            texts = [t or "" for t in piece.column("text").to_pylist()]
            if row is None:
                yield _edge(part, "first", rows[0], texts[0])
            else:
                rows, texts, own = [row, *rows], [text, *texts], [sketch, *own]
            yield _compared(rows[:-1], texts[:-1], texts[1:], own[:-1], own[1:])
            row, text, sketch = rows[-1], texts[-1], own[-1]
    if row is not None:
        yield _edge(part, "last", row, text)


def _paired(batches):
    """Rows with the text after them in a column of their own."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            row = tuple(one.column(c)[0].as_py() for c in (*KEY, "doc_id"))
            text, following = (one.column(c)[0].as_py() or "" for c in ("text", "following"))
            own, after = (sketches(pa.array([t], pa.large_string())) for t in (text, following))
            yield _compared([row], [text], [following], own, after)


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row per document: KEY, doc_id, n_chars (code points), edited_sha256, fingerprint and edited_fingerprint (sketches
    as bytes), near_edited and near_next (the share of the lesser text that the other has), jaccard_edited and jaccard_next."""
    docs = on_file(docs)
    order = [F.col("doc_id").asc_nulls_last(), *KEY]
    rows = keyed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    found = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_along, MIXED), "sketches")
    columns = [f.name for f in found.schema.fields][: -len(("part", "edge", "text"))]

    edges = found.where("edge IS NOT NULL")
    # One number for each task that had rows: as many as the scheduler itself keeps of this stage.
    parts = sorted(r.part for r in edges.where("edge = 'first'").select("part").collect())
    after = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, after int")
    firsts = edges.where("edge = 'first'").select(F.col("part").alias("after"), F.col("text").alias("following"))
    lasts = edges.where("edge = 'last'").select(*KEY, "doc_id", "part", "text")
    met = lasts.join(after, "part").join(firsts, "after")
    joined = met.select(*KEY, "doc_id", "text", "following").mapInArrow(_paired, MIXED)
    return found.where("edge IS NULL").select(*columns).unionByName(joined.select(*columns))
