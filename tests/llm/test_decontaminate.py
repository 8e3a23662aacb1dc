import hashlib
import random
import re

import pytest

from tidemark.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for doc, text in docs:
        own, hit, names, seen = words(text), set(), set(), False
        for item, question in items:
            q = words(question)
            n = min(13, len(q))
            for i in range(len(q) - n + 1 if n else 0):
                for j in range(len(own) - n + 1):
                    if own[j : j + n] == q[i : i + n]:
                        hit |= set(range(j, j + n))
                        names |= {str(item)} if item is not None else set()
        seen = bool(hit) and 20 * len(hit) >= len(own)
        out.append((doc, len(own), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), seen))
    return sorted(out, key=str)


def found(docs, items):
    return sorted((tuple(r) for r in D.contamination(docs, items).drop("at_file", "at_row").collect()), key=str)


@pytest.fixture()
def case(speak):
    items = [(i, " ".join(speak(n, 60))) for i, n in enumerate((40, 13, 14, 5, 1, 25, 3))] + [(2, "the same id"), (None, "null id here"), (90, None), (91, "?!")]
    docs = [(i, " ".join(speak(300, 60))) for i in range(20)]
    for k, (_, q) in enumerate(items[:7]):
        own = speak(40 * k + 20)
        docs.append((100 + k, " ".join(own + words(q) * (1 + k % 2) + own).upper().replace(" ", ", ")))
    docs += [(None, "Null ID here"), (7, "null id here"), (7, None), (8, ""), (9, "- - -"), (10, " ".join(speak(3000, 60)) + " " + items[0][1])]
    return docs, items


@pytest.mark.parametrize("segment", [D.SEGMENT_WORDS, 500])
def test_same_as_brute_force(documents, frame, case, monkeypatch, segment):
    monkeypatch.setattr(D, "SEGMENT_WORDS", segment)
    docs, items = case
    assert found(documents(docs), frame(items, "item_id long, text string")) == brute(docs, items)


def test_benchmark_in_blocks(documents, frame, case, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_BYTES", 200)
    docs, items = case
    assert found(documents(docs), frame(items, "item_id long, text string")) == brute(docs, items)


def test_empty_tables_and_clashes(documents, frame):
    items = frame([], "item_id long, text string")
    assert found(documents([]), items) == []
    assert found(documents([(1, "a b")]), items) == brute([(1, "a b")], [])
    docs = frame([(1, "a b", 1, 2, 3)], "doc_id long, text string, segment int, items int, n_words int")
    assert found(docs, frame([(1, "A b", 5)], "item_id long, text string, n int")) == brute([(1, "a b")], [(1, "a b")])


def test_proximity(documents):
    index = D.build_index(documents([(1, "red x green blue"), (2, "red y y y green blue"), (3, "green red blue"), (4, "red green")]))
    (phrase,) = D.windows([("p", "red green")], None)
    places = {r.ordinal for r in D.find(index, [phrase]).collect()}
    assert len(places) == 1
    assert D.find(index, [phrase], slop=1).count() == 2
    assert D.find(index, [phrase], slop=3).count() == 4


def test_postings_survive_packing():
    import numpy as np

    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 50, 1000).astype(np.uint64)
    order = np.argsort(hashes, kind="stable").astype(np.uint32)
    _, heads = np.unique(hashes[order], return_index=True)
    assert (D._unpacked(D._packed(order, heads), heads) == order).all()


def near(own, q, slop):
    """Spans of all ways to lay the phrase so that one word stands at its place, by trying each."""
    found = set()
    for b in range(-len(q) - slop, len(own) + slop + 1):
        stands = lambda p, w: 0 <= p < len(own) and own[p] == w
        near_by = all(any(stands(p, w) for p in range(b + i - slop, b + i + slop + 1)) for i, w in enumerate(q))
        if near_by and any(stands(b + i, w) for i, w in enumerate(q)):
            found.add((max(b, 0), min(b + len(q), len(own))))
    return {(b, e) for b, e in found if b < e}


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_proximity_against_brute_force(documents, slop):
    """Within a document only, and up to its edges."""
    rng = random.Random(slop)
    docs = [(1, "x red z"), (2, "green"), (3, "green red"), (4, "green red blue"), (5, ""), (6, None), (7, "red green"), (8, "red a b c green")]
    docs += [(i, " ".join(rng.choice(["red", "green", "blue", "x"]) for _ in range(rng.randrange(1, 12)))) for i in range(10, 70)]
    index = D.build_index(documents(docs).coalesce(1))
    ids = {(r.segment, i): d for r in index.select("segment", "doc_id").collect() for i, d in enumerate(r.doc_id)}
    for text in ("red green", "green blue red", "red red", "blue"):
        rows = D.find(index, D.windows([("q", text)], None), slop).collect()
        got = {ids[r.segment, r.ordinal]: {*zip(r.begins, r.ends)} for r in rows}
        wanted = {d: near(words(t), text.split(), slop) for d, t in docs}
        assert got == {d: spans for d, spans in wanted.items() if spans}
