"""Cross-entropy difference: how much better a model of a target corpus predicts a document than a model of all text.

Both models are interpolated bigram models over one vocabulary: all words of all documents, and one sign for any word
never seen. They have the same smoothing, and the background's counts are scaled to the target's size, so that neither is
sharper for having seen more. The target is the documents labelled good; the background is every document.

Words, words before, and pairs are counted over the whole corpus, summed within tasks first, which send sorted keys as packed
differences; nothing of it is left out. Keys meet by their upper bits, are summed, and each row of keys is answered with their
counts in all the corpus, in the same order, so a key goes once each way for some millions of tokens, however often they ask for it.
A task's texts go along as the places of their words in its own list of words. With the answers that is all a loss needs: texts are
read once. Results don't depend on ``FLUSH``, which only says how many tokens ask together.

A token's loss is -log2 of its probability after the word before it (or the beginning). A document's score is the mean of
target loss less background loss over its tokens: below nought, it's more like the target. Null and empty texts have no
tokens and null losses. Without any target the two models are equal and the differences nought. Repeated rows count
as often as they occur. A doc_id with several labels takes the largest. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.features import per_text
from tidemark.llm.frames import KEY, keyed, on_file, small, staged

#: Pseudo-counts: of a word without regard to the one before it, and of any word at all.
BACK_OFF, FLOOR = 8.0, 0.5
FLUSH = 1 << 20
BATCH_ROWS = 1 << 16
#: Counts are summed in groups of keys that stand for about so many bytes of text.
BUCKET_BYTES = 8 << 20
PACKED = pa.schema([("bucket", pa.int64()), ("kind", pa.int8()), ("keys", pa.binary()), ("n", pa.binary()), ("n_target", pa.binary())])
#: The same with the tokens that ask and the row's place among theirs, and (``TEXTS``) a row of their texts.
ROW = pa.struct([("at_file", pa.int64()), ("at_row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64())])
SENT = pa.schema([*PACKED, ("batch", pa.int64()), ("place", pa.int32()), ("docs", pa.list_(ROW))])
SENT_FORM = "bucket long, kind byte, keys binary, n binary, n_target binary, batch long, place int, docs array<struct<at_file:long, at_row:long, doc_id:long, n_tokens:long>>"
TEXTS = -1
#: Answers, and of each group of words (``SUMS``) what they are in all.
ANSWERED = pa.schema([*SENT, ("words", pa.int64()), ("tokens", pa.int64()), ("tokens_target", pa.int64())])
SUMS = -2
COUNTED = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("n", pa.int64()), ("n_target", pa.int64())])
#: Losses are summed as whole numbers of this part of a bit, so that sums don't depend on the order of rows.
PART = 1 << 30

U64 = np.uint64
BEGIN, BEFORE, BOTH = U64(0x9B05688C2B3E6C1F), U64(0x5BE0CD19137E2179), U64(0xD1342543DE82EF95)
#: What a token asks for: the count of its word, of the word before it as such, and of the pair.
ASKED = ["word", "before", "pair"]


def keys(found: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Of each token, the key of each of ``ASKED``."""
    before = np.concatenate(([BEGIN], found[:-1])) if len(found) else found
    before[at[:-1][np.diff(at) > 0]] = BEGIN
    return [found, tokens.mix(before + BEFORE), tokens.mix(tokens.mix(before) * BOTH + found)]


def _own(piece: pa.RecordBatch, at: np.ndarray) -> np.ndarray:
    return np.repeat(piece.column("target").to_numpy(zero_copy_only=False), np.diff(at))


def _planes(values: np.ndarray) -> bytes:
    """How many, and bytes of one place next to each other, compressed: of small numbers little is left."""
    planes = np.ascontiguousarray(values.astype(np.int64, copy=False).view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(pa.py_buffer(planes), codec="zstd", asbytes=True)


def _from_planes(data) -> np.ndarray:
    data = data.as_buffer()
    planes = pa.decompress(data.slice(8), 8 * int.from_bytes(data.slice(0, 8).to_pybytes(), "little"), codec="zstd")
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _texts(held: list, place: np.ndarray) -> pa.RecordBatch:
    """The texts of these pieces as a row: the place of each token among their different words, which are sent to be counted."""
    columns = [pa.concat_arrays(c) for c in zip(*[rows for *_, rows in held], strict=True)]
    docs = pa.StructArray.from_arrays(columns, fields=list(ROW))
    # Named by the first of them; a row's place in its file never repeats.
    first = [docs[0][c].as_py() for c in KEY]
    batch = int(tokens.mix(tokens.mix(np.array(first[:1], np.int64).view(U64)) * BOTH + U64(first[1])).view(np.int64)[0])
    row = {"bucket": batch, "kind": TEXTS, "n": _planes(place), "batch": batch}
    return pa.RecordBatch.from_arrays([pa.array([row.get(c)], SENT.field(c).type) if c != "docs" else pa.ListArray.from_arrays([0, len(docs)], docs) for c in SENT.names], schema=SENT)


def _counts(batches, flush: int = FLUSH, texts: bool = False):
    """Counts of all keys in all texts and in target texts, summed over some millions of tokens; before them, if asked for, a row of these texts."""
    held, n, many = [], 0, 0

    def summed():
        target = np.concatenate([t for _, t, *_ in held])
        for kind in range(len(ASKED)):
            key, inverse = np.unique(np.concatenate([k[kind] for k, *_ in held]), return_inverse=True)
            if texts and kind == 0:
                yield _texts(held, inverse)
            many = (np.bincount(inverse, minlength=len(key)), np.bincount(inverse, target, len(key)).astype(np.int64))
            columns = (np.full(len(key), kind, np.int8), key.view(np.int64), *many)
            for i in range(0, len(key), BATCH_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + BATCH_ROWS]) for c in columns], ["kind", "key", "n", "n_target"])

    for batch in batches:
        for piece in tokens.pieces(batch):
            found, at = tokens.words(piece.column("text"))
            # Not the piece, which would hold the whole batch's texts.
            rows = [*[piece.column(c) for c in (*KEY, "doc_id")], pa.array(np.diff(at))] if texts else []
            held.append((keys(found, at), _own(piece, at), rows))
            n, many = n + len(found), many + piece.num_rows
            # Texts without tokens count as well, so that not too many are held.
            if n >= flush or many >= FLUSH >> 4:
                yield from summed()
                held, n, many = [], 0, 0
    if held:
        yield from summed()


def _packed(bits: int, flush: int = FLUSH, texts: bool = False):
    """The same as a row per kind and upper ``bits`` of the keys, with the differences of the sorted keys."""

    def run(batches):
        asking, place = None, 0
        for batch in _counts(batches, flush, texts):
            if batch.schema == SENT:
                asking, place = batch.column("batch")[0].as_py(), 0
                yield batch
                continue
            key, n, n_target = (batch.column(c).to_numpy() for c in ("key", "n", "n_target"))
            key = key.view(U64)
            bucket = (key >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)
            heads = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
            rows = []
            for i, j in zip(heads, [*heads[1:], len(key)], strict=True):
                step = np.diff(key[i:j], prepend=U64(0)).view(np.int64)
                rows.append({"bucket": int(bucket[i]), "kind": batch.column("kind")[0].as_py(), "keys": _planes(step), "n": _planes(n[i:j]), "n_target": _planes(n_target[i:j]), "batch": asking, "place": place + len(rows)})
            place += len(rows)
            yield pa.RecordBatch.from_pylist(rows, SENT if texts else PACKED)

    return run


def _total(table: pa.Table) -> pa.Table:
    """Of the rows of a kind and bucket: each key's counts. Of what was counted once, only words stay, since they are numbered."""
    kind = table.column("kind")[0].as_py()
    key = np.concatenate([np.cumsum(_from_planes(k).view(U64)) for k in table.column("keys")])
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    n, n_target = (np.add.reduceat(np.concatenate([_from_planes(c) for c in table.column(name)])[order], heads) for name in ("n", "n_target"))
    stay = np.ones(len(heads), bool) if kind == 0 else n > 1
    return pa.table([np.full(int(stay.sum()), kind, np.int8), key[heads][stay].view(np.int64), n[stay], n_target[stay]], COUNTED)


def _losses(word, before, pair, scale: float, tokens_in_all: float, vocabulary: int) -> np.ndarray:
    """-log2 of the probability of tokens with these counts."""
    single = (word * scale + FLOOR) / (tokens_in_all * scale + FLOOR * vocabulary)
    return -np.log2((pair * scale + BACK_OFF * single) / (before * scale + BACK_OFF))


def _answers(table: pa.Table) -> pa.Table:
    """Each row of a kind and bucket with the counts of its keys in all the corpus; only words keep their keys. Texts stay as they are."""
    kind = table.column("kind")[0].as_py()
    if kind == TEXTS:
        return pa.table([*table.columns, *[pa.nulls(table.num_rows, pa.int64())] * 3], ANSWERED)
    total = _total(table)
    common, *counts = (total.column(c).to_numpy() for c in ("key", "n", "n_target"))
    common = common.view(U64)
    rows = table.select(["bucket", "kind", "batch", "place"]).to_pylist()
    for row, packed, own in zip(rows, table.column("keys"), table.column("n_target"), strict=True):
        key = np.cumsum(_from_planes(packed).view(U64))
        at = np.minimum(np.searchsorted(common, key), max(len(common) - 1, 0))
        # What isn't in the total was counted once, here.
        here = common[at] == key if len(common) else np.zeros(len(key), bool)
        n, n_target = (np.where(here, c[at], once) if len(common) else once for c, once in zip(counts, (np.ones(len(key), np.int64), _from_planes(own)), strict=True))
        row |= {"keys": packed if kind == 0 else None, "n": _planes(n), "n_target": _planes(n_target)}
    if kind == 0:
        rows.append({"bucket": rows[0]["bucket"], "kind": SUMS, "words": len(common), "tokens": int(counts[0].sum()), "tokens_target": int(counts[1].sum())})
    return pa.Table.from_pylist(rows, ANSWERED)


FORM = "at_file long, at_row long, doc_id long, n_tokens long, target_part long, background_part long"


def _scores(models):
    """A row per document of a batch, from its texts and the answers to its keys."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("kind", "ascending"), ("place", "ascending")])
        kind = table.column("kind").to_numpy()
        (texts,) = table.filter(pa.array(kind == TEXTS)).to_batches()
        docs = texts.column("docs").values
        n = docs.field("n_tokens").to_numpy()
        at = np.concatenate(([0], np.cumsum(n)))
        words = [np.cumsum(_from_planes(k).view(U64)) for k in table.filter(pa.array(kind == 0)).column("keys")]
        found = np.concatenate([np.zeros(0, U64), *words])[_from_planes(texts.column("n")[0])]
        answers = []
        for k, key in enumerate(keys(found, at)):
            which, inverse = np.unique(key, return_inverse=True)
            rows = table.filter(pa.array(kind == k))
            counts = [np.concatenate([np.zeros(0, np.int64), *map(_from_planes, rows.column(c))]) for c in ("n", "n_target")]
            if len(counts[0]) != len(which):
                raise RuntimeError(f"{len(counts[0])} answers to {len(which)} keys")
            answers.append([c[inverse] for c in counts])
        sums = [per_text(np.rint(_losses(*[a[which] for a in answers], *model) * PART).astype(np.int64), at) for which, model in models]
        return pa.table([*docs.flatten(), *map(pa.array, sums)], names=[c.split()[0] for c in FORM.split(", ")])

    return run


def targets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """KEY, doc_id, text and target (1 or 0) of every document, by the labels' quality."""
    good = labels.select(labels["doc_id"].alias("doc_id"), labels["quality"].alias("quality")).where("doc_id IS NOT NULL")
    good = staged(good.groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality > 0").select("doc_id", F.lit(1).alias("target")), "targets")
    rows = keyed(on_file(docs), "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.join(small(good, 24), "doc_id", "left").withColumn("target", F.coalesce("target", F.lit(0)))


def score(rows: DataFrame, flush: int = FLUSH) -> DataFrame:
    """A row per document: KEY, doc_id, n_tokens, target_loss, background_loss, difference."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = (size // BUCKET_BYTES).bit_length()
    sent = rows.select(*KEY, "doc_id", "text", "target").mapInArrow(_packed(bits, flush, True), SENT_FORM)
    found = sent.groupBy("kind", "bucket").applyInArrow(_answers, SENT_FORM + ", words long, tokens long, tokens_target long")
    found = staged(found, "answers")
    n, n_target, vocabulary = found.where(F.col("kind") == SUMS).agg(*[F.sum(c) for c in ("tokens", "tokens_target", "words")]).first()
    # Which count, and its scale: of two equal models without any target.
    ratio = (n_target or 0) / max(1, n or 0)
    scales = [(1, 1.0), (0, ratio)] if ratio else [(0, 1.0)] * 2
    models = [(which, (scale, float((n, n_target)[which] or 0), (vocabulary or 0) + 1)) for which, scale in scales]
    found = found.where(F.col("kind") != SUMS).select("batch", "kind", "place", "keys", "n", "n_target", "docs")
    found = found.groupBy("batch").applyInArrow(_scores(models), FORM)
    means = [(F.col(f"{k}_part") / F.lit(float(PART)) / F.nullif("n_tokens", F.lit(0))).alias(f"{k}_loss") for k in ("target", "background")]
    return found.select(*KEY, "doc_id", "n_tokens", *means).withColumn("difference", F.col("target_loss") - F.col("background_loss"))
