import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lexical as L

ITEMS = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items):
    """By hand: all documents for all items."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, n_all = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for at, ((doc, c), n) in enumerate(zip(counted, sizes)):
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * (10 + (90 * n * n_docs) // n_all)))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, at, doc))
        out += [(item, rank, s[4], -s[0]) for rank, s in enumerate(sorted(scores)[:10], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()], key=repr)


@pytest.fixture()
def corpus():
    """Documents of Zipf-like words, some very long, many alike; and items cut out of them."""
    rng = random.Random(11)
    say = lambda n: " ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(n))
    texts = [say(rng.choice([1, 4, 30, 200])) for _ in range(300)] + [say(20_000), say(40)] + [say(60)] * 25
    texts += [None, "", " .,;", "É é 😀 straße STRASSE", "wort wort wort wort wort wort wort wort wort wort"]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choice(texts[:330]).split()[:30])) for i in range(25)]
    items += [(100, None), (101, ""), (102, "?!"), (103, "nowhere to be found"), (104, "é STRASSE wort"), (105, "w1"), (3, "w7 w7 w8"), (None, "w9 w10")]
    return docs, items


def test_against_brute_force(documents, frame, corpus):
    docs, items = corpus
    assert found(L.search(documents(docs), frame(items, ITEMS))) == expected(docs, items)


def test_small_segments_blocks_and_no_broadcast(documents, frame, corpus, monkeypatch):
    """The same with several blocks of items, little work at a time, few probes, and candidates that are too many to send."""
    docs, items = corpus
    from tidemark.llm import frames

    monkeypatch.setattr(L, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(L, "WORK_BYTES", 2000)
    monkeypatch.setattr(L, "PROBE", 10)
    monkeypatch.setattr(frames, "BROADCAST_BYTES", 100)
    assert found(L.search(documents(docs), frame(items, ITEMS))) == expected(docs, items)


def test_bounds_hold_and_exclude(corpus):
    docs, items = corpus
    texts = [(at, L.tokens.words(L.pa.array([t or ""]), L.tokens.LETTERS)[0]) for at, (_, t) in enumerate(docs)]
    texts = [(at, h) for at, h in texts if len(h)]
    asked = [np.unique(L.tokens.words(L.pa.array([t or ""]), L.tokens.LETTERS)[0]) for _, t in items]
    asked = [a for a in asked if len(a)]
    all_terms = np.unique(np.concatenate(asked))
    df = np.array([sum(t in h for _, h in texts) for t in all_terms])
    weight = L.weights(df, len(texts))
    model = L.Model([np.searchsorted(all_terms, a) for a in asked], all_terms, len(texts), sum(len(h) for _, h in texts), weight)
    width, passed, held = 1 << 15, 0, 0
    segment = L._Open(width)
    for at, h in texts:
        own, n = np.unique(h, return_counts=True)
        segment.add((0, at, at, len(h)), np.concatenate([L.entries(own[n >= least], i) for i, least in enumerate(L.LEVELS)]))
    sizes = np.array([len(h) for _, h in texts])
    for item, bound in model.bounds(width, sizes, segment.slices):
        exact = np.array([model.score(h, [item])[0] for _, h in texts])
        assert (bound >= exact).all()
        best = np.sort(exact)[-10]
        if best > 0 and len(asked[item]) > 5:
            passed += int((bound >= best).sum())
            held += int((exact >= best).sum())
    assert held > 150 and passed <= 1.5 * held


def test_ties_by_id_nulls_last_and_repeats(documents, frame):
    docs = [(None, "a b"), (5, "a b"), (2, "a b"), (2, "a b"), *[(i, "c d") for i in range(20, 60)]]
    got = found(L.search(documents(docs), frame([(1, "a"), (1, "a")], ITEMS)))
    assert [(r, d) for _, r, d, _ in got] == [(1, 2), (1, 2), (2, 2), (2, 2), (3, 5), (3, 5), (4, None), (4, None)]


def test_a_term_in_every_document_weighs_nothing_here(documents, frame):
    docs = [(i, "same") for i in range(4000)]
    assert found(L.search(documents(docs), frame([(1, "same")], ITEMS))) == expected(docs, [(1, "same")]) == []


def test_empty_tables_and_clashing_columns(documents, frame):
    assert found(L.search(documents([]), frame([(1, "a")], ITEMS))) == []
    empty = L.search(documents([(1, "a")]), frame([], ITEMS))
    assert found(empty) == [] and empty.columns == ["item_id", "rank", "doc_id", "score", "at_file", "at_row"]
    assert found(L.search(documents([(1, None)]), frame([(1, "a")], ITEMS))) == []
    docs = frame([(1, "a b", 3, 4, 5), (2, "c", 3, 4, 5)], "doc_id long, text string, item int, score int, items int")
    items = frame([("x", "a", 1, 2)], "item_id string, text string, rank int, doc_id long")
    assert found(L.search(docs, items)) == expected([(1, "a b"), (2, "c")], [("x", "a")])
