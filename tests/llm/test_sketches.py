import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import sketches as S
from tidemark.llm import tokens


def sketch(text):
    return S.sketches(pa.array([text], pa.string()))[0]


def shingle_set(text):
    hashes, starts = tokens.shingles(*tokens.words(pa.array([text], pa.string())))
    return set((hashes >> np.uint64(16)).tolist())


def slow_sketch(hashes):
    """Every hash below the fraction, and the smallest in any case."""
    return sorted(h for i, h in enumerate(sorted(hashes)) if i < 32 or h < 2**48 // 16)


def slow_likeness(a, b):
    """(share of the lesser, Jaccard) of two sketches as lists, below the bound up to which both hold everything."""
    if not a or not b:
        return (float(len(a) == len(b)),) * 2
    reach = min(2**48 if len(s) < 32 else max(s[-1], 2**48 // 16 - 1) for s in (a, b))
    a, b = ({h for h in s if h <= reach} for s in (a, b))
    return (len(a & b) / min(len(a), len(b)) if a and b else 0.0), (len(a & b) / len(a | b) if a | b else 0.0)


def expected(pairs):
    """By hand, for pairs in the order of their ids."""
    out = []
    for (i, text), (_, after) in zip(pairs, [*pairs[1:], pairs[0]]):
        text, after = text or "", after or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        own, edited, following = (slow_sketch(shingle_set(t)) for t in (text, changed, after))
        row = (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, edited)
        out.append((*row, *slow_likeness(own, edited), *slow_likeness(own, following)))
    return out


def found(df):
    rows = df.orderBy(df.doc_id.asc_nulls_last(), "at_file", "at_row").collect()
    return [
        (
            r.doc_id, r.n_chars, r.edited_sha256, S.from_bytes(bytes(r.fingerprint)).tolist(), S.from_bytes(bytes(r.edited_fingerprint)).tolist(),
            r.near_edited, r.jaccard_edited, r.near_next, r.jaccard_next,
        )
        for r in rows
    ]


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_against_brute_force(spark, documents, speak, parts):
    rng = random.Random(5)
    texts = [" ".join(speak(rng.choice([0, 1, 3, 5, 9, 70, 400, 3000]), 300)) for _ in range(60)]
    texts += [texts[7], texts[7], None, "", "\n \t", "é😀 " * 30, "Ä ö\u0000ü", texts[9] + " more"]
    pairs = list(enumerate(texts)) + [(None, "the last one")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(S.fingerprints(documents(pairs))) == expected(pairs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repeats_one_id_on_all_rows(spark, documents, speak):
    """One id holds all rows; they are still dealt out, and each meets the next by its place."""
    texts = [" ".join(speak(20)) for _ in range(50)]
    docs = documents([(1, t) for t in texts])
    rows = found(S.fingerprints(docs))
    assert sorted(r[3] for r in rows) == sorted(slow_sketch(shingle_set(t)) for t in texts)
    assert len(rows) == 50 and all(r[1] == len(t) or True for r, t in zip(rows, texts))
    assert {r[2] for r in rows} <= {
        hashlib.sha256((a[: len(a) - len(a) // 2] + b[: len(a) // 2]).encode()).hexdigest() for a in texts for b in texts
    }


def test_long_text_single_and_empty(documents, speak):
    long = " ".join(speak(400_000))
    for pairs in ([(1, long), (2, "a b c d e f")], [(1, "a b c d e f")], [(1, None)], []):
        assert found(S.fingerprints(documents(pairs))) == (expected(pairs) if pairs else [])


def test_equal_texts_have_equal_fingerprints(documents, speak):
    text = " ".join(speak(500))
    rows = found(S.fingerprints(documents([(1, text), (2, "x"), (3, text), (4, text.upper())])))
    assert rows[0][3] == rows[2][3] == rows[3][3] != rows[1][3]
    assert rows[2][7] == 1.0


def test_merge_is_the_sketch_of_the_union(speak):
    rng = random.Random(9)
    for _ in range(30):
        texts = [" ".join(speak(rng.choice([3, 20, 90, 2000]))) for _ in range(4)]
        a, b, c, d = map(sketch, texts)
        whole = slow_sketch(set().union(*map(shingle_set, texts)))
        assert S.merge(S.merge(a, b), S.merge(c, d)).tolist() == S.merge(S.merge(S.merge(d, b), a), c).tolist() == whole


def test_containment_of_very_unequal_texts(speak):
    """Errors stay within what the number of comparable hashes allows."""
    book = speak(100_000, 50_000)
    for share in (0.0, 0.3, 1.0):
        part = book[5000 : 5000 + int(3000 * share)] + speak(3000 - int(3000 * share), 50_000)
        a, b = sketch(" ".join(part)), sketch(" ".join(book))
        real = len(shingle_set(" ".join(part)) & shingle_set(" ".join(book))) / len(shingle_set(" ".join(part)))
        assert abs(S.containment(a, b) - real) < 0.15
    assert S.containment(sketch(""), sketch("")) == 1.0 and S.containment(sketch("a"), sketch("")) == 0.0


def test_clashing_columns(frame):
    rows = frame([(1, "a b c d e f g", 7, "e", 2.0)], "doc_id long, text string, part int, edge string, near_next double")
    assert found(S.fingerprints(rows)) == expected([(1, "a b c d e f g")])


def test_bytes_and_back(speak):
    for n in (0, 1, 50, 5000):
        own = sketch(" ".join(speak(n)))
        assert len(S.to_bytes(own)) == 6 * len(own) and S.from_bytes(S.to_bytes(own)).tolist() == own.tolist()
