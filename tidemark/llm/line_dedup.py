"""Line deduplication by pairwise alignment: what a later document shares with an earlier one, in order, is deleted there.

Documents that overlap are found through runs of adjacent lines that both hold: from each line on, and back from each, the
shortest run of ``BLOCK_BYTES`` or more. Of a common block of that size every line is in such a run within the block, however
short its lines are. A run that few documents hold (``RARE`` or fewer) pairs each of them with every earlier one; a run that
more hold pairs each with the first that holds it, so that it costs one pair per document however many there are. Each pair is aligned with patience diff: lines that
are unique in both are put into a longest common order, and the same is done between them. Aligned runs of lines of
``BLOCK_BYTES`` or more are deleted from the later document.

Later means a greater doc_id (nulls last), then a later place in the input; so all but the first of repeated rows lose
their lines. Lines are compared as they are but for the case of A-Z; lines of white space only neither match nor count as
different, and go with the lines around them. A null text stays null. Empty tables give empty results.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.features import BLANK
from tidemark.llm.frames import KEY, keyed, on_file, small, staged

RARE = 8
BLOCK_BYTES = 40

U64 = np.uint64
STEP = 0xD1342543DE82EF95


def runs(lines: np.ndarray, sizes: np.ndarray, where: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shortest runs of ``least`` bytes or more from each line on and back from each, and the text each is of."""
    n, text = len(lines), np.repeat(np.arange(len(where) - 1), np.diff(where))
    size = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    up, down = (np.concatenate((np.ones(1, U64), np.cumprod(np.full(n, U64(f))))) for f in (STEP, pow(STEP, -1, 2**64)))
    total = np.concatenate((np.zeros(1, U64), np.cumsum(lines * up[:n])))
    at = np.arange(n)
    ends, begins = np.searchsorted(size, size[:-1] + least), np.searchsorted(size, size[1:] - least, "right") - 1
    on, back = ends <= where[text + 1], begins >= where[text]
    begin, end = np.concatenate((at[on], begins[back])), np.concatenate((ends[on], at[back] + 1))
    return tokens.mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(U64)), np.concatenate((text[on], text[back]))


def _lines(least: int):
    def run(batches):
        for batch in batches:
            for piece in tokens.pieces(batch):
                data, offsets = tokens.text_bytes(piece.column("text"))
                begins, ends, at = tokens.spans(data, offsets, tokens.LINES)
                found = tokens.word_hashes(data, begins, tokens.LINES)
                blank = np.concatenate(([0], np.cumsum(BLANK[data])))
                full = (blank[ends] - blank[begins]) < ends - begins
                where = np.concatenate(([0], np.cumsum(full)))[at].astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(where), pa.array(c[full])) for c in (found.view(np.int64), (ends - begins).astype(np.int32))]
                signs, text = runs(found[full], (ends - begins)[full], where, least)
                order = np.argsort(text, kind="stable")
                bounds = np.searchsorted(text[order], np.arange(len(where))).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(signs[order].view(np.int64))))
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in (*KEY, "doc_id")], *lists], [*KEY, "doc_id", "lines", "sizes", "runs"])

    return run


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Patience diff: places in a and in b of the lines that stand in both, in common order."""
    found, work = [], [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {line: i for i, line in enumerate(a[a0:a1], a0) if in_a[line] == 1 == in_b.get(line)}
        chain = _longest([(place[line], j) for j, line in enumerate(b[b0:b1], b0) if line in place])
        if chain:
            edges = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
            found += chain
            work += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges[:-1], edges[1:], strict=True) if i + 1 < k and j + 1 < m]
    return sorted(found)


def _longest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs, in order of the second, whose firsts rise."""
    tops, last, before = [], [], [-1] * len(pairs)
    for k, (i, _) in enumerate(pairs):
        at = bisect_left(tops, i)
        before[k] = last[at - 1] if at else -1
        tops[at : at + 1], last[at : at + 1] = [i], [k]
    k, chain = last[-1] if last else -1, []
    while k >= 0:
        chain.append(pairs[k])
        k = before[k]
    return chain[::-1]


def shared_blocks(a: list, b: list, sizes: list, least: int = BLOCK_BYTES) -> list[int]:
    """Places in b of the lines in aligned runs of ``least`` bytes or more."""
    out, run = [], []
    for pair in [*align(a, b), None]:
        if run and (pair is None or pair != (run[-1][0] + 1, run[-1][1] + 1)):
            if sum(sizes[j] for _, j in run) >= least:
                out += [j for _, j in run]
            run = []
        run.append(pair)
    return out


def _aligned(least: int):
    def run(batches):
        for batch in batches:
            found = [shared_blocks(*row, least) for row in zip(*(batch.column(c).to_pylist() for c in ("first", "later", "sizes")), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in KEY], pa.array(found, pa.list_(pa.int32()))], [*KEY, "gone"])

    return run


def overlaps(lines: DataFrame, rare: int = RARE) -> DataFrame:
    """Pairs of rows, ``first`` and ``later`` (structs), that share a run of lines."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *KEY)
    held = lines.select(order.alias("row"), F.explode(F.array_distinct("runs")).alias("line"))
    known = held.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first")).where("n > 1")
    marked = staged(held.join(known, "line"), "held-lines")
    star = marked.where((F.col("n") > rare) & (F.col("row") != F.col("first"))).select("first", F.col("row").alias("later"))
    few = marked.where(F.col("n") <= rare)
    each = few.select("line", F.col("row").alias("first")).join(few.select("line", F.col("row").alias("later")), "line").where("first < later")
    return staged(star.unionByName(each.select("first", "later")).distinct(), "overlaps")


def _cut(batches):
    for batch in batches:
        texts, counts = [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            kept, k, dropped, dropping = [], 0, set(gone or ()), False
            for line in (text or "").split("\n"):
                if line.strip(" \t\r\x0b\x0c"):
                    dropping = k in dropped
                    k += 1
                if not dropping:
                    kept.append(line)
            counts.append(k)
            texts.append(text if not dropped else "\n".join(kept))
        columns = [*[batch.column(c) for c in (*KEY, "doc_id")], pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array([len(set(g or ())) for g in batch.column("gone").to_pylist()], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [*KEY, "doc_id", "text", "n_lines", "n_deleted"])


def dedup_lines(docs: DataFrame, rare: int = RARE, least: int = BLOCK_BYTES) -> DataFrame:
    """A row per document: KEY, doc_id, text (what is left of it), n_lines, n_deleted."""
    docs = on_file(docs)
    rows = keyed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    lines = staged(rows.mapInArrow(_lines(least), "at_file long, at_row long, doc_id long, lines array<long>, sizes array<int>, runs array<long>"), "lines")
    pairs = overlaps(lines, rare).select(*[F.col(s)[k].alias(f"{s}_{k}") for s in ("first", "later") for k in KEY])
    side = lambda s, *c: lines.select(*[F.col(k).alias(f"{s}_{k}") for k in KEY], F.col("lines").alias(s), *c)
    pairs = pairs.join(side("first"), [f"first_{k}" for k in KEY]).join(side("later", "sizes"), [f"later_{k}" for k in KEY])
    pairs = pairs.select(*[F.col(f"later_{k}").alias(k) for k in KEY], "first", "later", "sizes")
    gone = pairs.mapInArrow(_aligned(least), "at_file long, at_row long, gone array<int>").where(F.size("gone") > 0)
    gone = staged(gone.groupBy(*KEY).agg(F.array_distinct(F.flatten(F.collect_set("gone"))).alias("gone")), "gone")
    marked = rows.join(small(gone, 128, "gone"), KEY, "left")
    return marked.mapInArrow(_cut, "at_file long, at_row long, doc_id long, text string, n_lines long, n_deleted long")


