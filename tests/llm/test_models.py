"""Trees, calibration, toxicity, quality and language models."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tidemark.llm.frames import RELEASE, staged
from tidemark.llm.labelled import sample
from tidemark.llm.lm_score import BACK_OFF, FLOOR, TEXTS, _answers, _counts, _from_planes, _packed, _total, score, targets
from tidemark.llm.quality import posteriors, quality
from tidemark.llm.toxicity import toxicity
from tidemark.llm.trees import Isotonic, Trees, calibrated

LABELS = "doc_id long, quality int, toxic int"


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    trees, curve = calibrated(x[:2000], y[:2000])
    p = curve(trees.logit(x[2000:]))
    assert ((p > 0.5) == y[2000:]).mean() > 0.97 and p.min() >= 0 and p.max() <= 1


def test_isotonic_rises_and_is_calibrated():
    rng = np.random.default_rng(1)
    s = rng.random(5000)
    y = (rng.random(5000) < s**2).astype(float)
    curve = Isotonic().fit(s, y)
    grid = np.linspace(0, 1, 101)
    assert (np.diff(curve(grid)) >= 0).all() and np.abs(curve(grid) - grid**2).mean() < 0.05


def test_one_class_only():
    x = np.random.default_rng(2).random((30, 2))
    for y in (np.zeros(30), np.ones(30)):
        trees, curve = calibrated(x, y)
        assert abs(curve(trees.logit(x)).mean() - y[0]) < 0.1
    trees, curve = calibrated(np.zeros((0, 2)), np.zeros(0))
    assert curve(trees.logit(x)).tolist() == [0.5] * 30
    assert Trees().fit(x, np.zeros(30)).nodes == []


@pytest.fixture()
def judged(speak):
    """Documents with good and bad, toxic and clean ones, and their labels."""
    rng, docs, labels = random.Random(4), [], []
    for i in range(900):
        own, bad, toxic = speak(rng.choice([20, 60, 200])), rng.random() < 0.2, rng.random() < 0.2
        if bad:
            own = [w.upper() + "!!" for w in own]
        if toxic:
            for _ in range(3):
                own.insert(rng.randrange(len(own)), rng.choice(["you idiot", "grumpf", "M0R0N", "grumpf"]))
        docs.append((i, " ".join(own)))
        if rng.random() < 0.8:
            labels.append((i, int(not bad), int(toxic)))
    return docs, labels


def test_toxicity_of_held_out_rows(documents, frame, judged):
    docs, labels = judged
    docs = docs + [(None, None), (2000, ""), (2001, "x" * 200_000), (5, docs[5][1])]
    truth = {i: t for i, _, t in labels}
    wrong = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    rows = toxicity(documents(docs), frame(wrong, LABELS)).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and sum(t == p for t, p in held) / len(held) > 0.95
    assert {r.predicted for r in rows if r.doc_id in (None, 2000)} == {0}


def test_toxicity_without_labels(documents, frame):
    assert [r.score for r in toxicity(documents([(1, "a")]), frame([], LABELS)).collect()] == [0.5]
    assert toxicity(documents([]), frame([(1, 1, 1)], LABELS)).collect() == []


def test_quality_rejects_the_bad_and_keeps_the_good(documents, frame, judged):
    docs, labels = judged
    truth = {i: q for i, q, _ in labels}
    rows = quality(documents([*docs, (None, None), (3000, "")]), frame(labels, LABELS)).collect()
    assert len(rows) == len(docs) + 2 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.kept == bool(truth[r.doc_id]) for r in rows if r.doc_id in truth]) > 0.97
    assert quality(documents([]), frame([], LABELS)).collect() == []
    assert all(r.kept for r in quality(documents([(1, "a")], source=None), frame([], LABELS)).collect())


def test_sparse_groups_are_shrunk(frame):
    rng = random.Random(1)
    rows = []
    for h in range(12):
        rate = 0.95 if h % 2 else 0.4
        rows += [(f"h{h}", f"p{k % 2}", float(rng.random() < rate)) for k in range(200)]
    rows += [("new", "p", 0.0), ("h1", "lone", 0.0), (None, None, 1.0)]
    table, rate = posteriors(frame(rows, "host string, path string, evidence double"))
    found = {(r.host, r.path): r for r in table.collect()}
    assert abs(rate - np.mean([r[2] for r in rows])) < 1e-9 and len(found) == 27
    assert 0.05 < found["new", "p"].path_rate < rate
    assert found["h1", "lone"].path_rate > 0.5 and found["h0", "p0"].path_rate < 0.5 < found["h1", "p0"].path_rate
    assert found[None, None].path_rate > rate


def brute_losses(docs, good, size):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    total = Counter(w for _, t in docs for w in split(t))
    known = {w for w, _ in total.most_common(size)}
    runs = [[w if w in known else None for w in split(t)] for _, t in docs]
    models = []
    for texts in ([r for r, (i, _) in zip(runs, docs, strict=True) if i in good], runs):
        pairs = Counter(p for r in texts for p in zip(["<s>", *r], r))
        models.append(pairs)
    ratio = sum(models[0].values()) / sum(models[1].values())
    out = {}
    for (i, _), r in zip(docs, runs, strict=True):
        means = []
        for pairs, scale in zip(models, (1, ratio), strict=True):
            single, before = Counter(), Counter()
            for (h, w), n in pairs.items():
                single[w] += n * scale
                before[h] += n * scale
            all_words = sum(single.values()) + FLOOR * (len(known) + 1)
            loss = 0
            for h, w in zip(["<s>", *r], r):
                p = (single[w] + FLOOR) / all_words
                loss -= math.log2((pairs[h, w] * scale + BACK_OFF * p) / (before[h] + BACK_OFF))
            means.append(loss / len(r) if r else None)
        out[i] = (len(r), *means)
    return out


def test_cross_entropy_difference(documents, frame, speak):
    common = [f"c{i}" for i in range(12)]
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(common[: 6 if i % 3 else 12]) for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, " ".join(["c1", "c2"] * 3000))]
    good = {i for i, _ in docs if i % 3}
    labels = [(i, int(i in good), 0) for i, _ in docs] + [(1, 0, 0), (None, 1, 0)]
    # All of the twelve words are in the vocabulary, so that ties among rarer ones don't matter.
    rows = score(targets(documents(docs), frame(labels, LABELS)), 12).collect()
    expected = brute_losses(docs, good, 12)
    assert len(rows) == len(docs)
    for r in rows:
        n, target, background = expected[r.doc_id]
        assert r.n_tokens == n
        assert (r.target_loss is None) == (n == 0)
        if n:
            assert r.target_loss == pytest.approx(target, rel=1e-4) and r.background_loss == pytest.approx(background, rel=1e-4)
            assert r.difference == pytest.approx(target - background, abs=1e-3)


@pytest.mark.parametrize("hot", [0, 40, 1 << 20])
def test_every_word_is_in_the_models(documents, frame, speak, hot):
    """More words than any fixed vocabulary, rare ones and pairs too, wherever their counts are looked up."""
    rng, phrase = random.Random(6), speak(30, 10**9)
    docs = [(i, " ".join(speak(60, 3000) + speak(20, 10**9) + (phrase[: rng.randrange(30)] if i % 4 else []) + ["the"] * rng.randrange(9))) for i in range(120)]
    docs += [(120, None), (121, " "), (122, docs[3][1])]
    good = {i for i, _ in docs if i % 3}
    rows = score(targets(documents(docs), frame([(i, 1, 0) for i in good], LABELS)), hot).collect()
    expected = brute_losses(docs, good, 10**9)
    assert len(rows) == len(docs) and len({w for _, t in docs for w in (t or "").split()}) > 4000
    for r in rows:
        n, target, background = expected[r.doc_id]
        assert r.n_tokens == n
        if n:
            assert r.target_loss == pytest.approx(target, rel=1e-7) and r.background_loss == pytest.approx(background, rel=1e-7)


def test_no_target_no_difference(documents, frame):
    rows = score(targets(documents([(1, "a b c"), (2, "d")]), frame([], LABELS))).collect()
    assert {r.difference for r in rows} == {0.0}
    assert score(targets(documents([]), frame([], LABELS))).collect() == []


def test_the_bound_of_a_sample_is_on_documents(documents, frame):
    labels = frame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    docs = documents([(i % 20 if i < 60 else 1, f"text {i}") for i in range(6000)])
    found = sample(docs, labels, "toxic", 500).collect()
    assert 350 <= len(found) <= 650 and {r.y for r in found} == {0, 1}
    # All of them where they are fewer; two labels of a document count once.
    twice = labels.unionByName(labels)
    assert sample(docs, twice, "toxic", 10_000).count() == 6000
    assert sample(documents([]), labels, "toxic").count() == 0 and sample(docs, labels.limit(0), "toxic").count() == 0


def test_counts_leave_a_task_in_small_batches():
    text = " ".join(f"w{k}" for k in range(150_000))
    batch = pa.RecordBatch.from_pydict({"text": [text, "w1 w1"], "target": pa.array([1, 0], pa.int32())})
    found = list(_counts([batch]))
    assert max(b.num_rows for b in found) <= 1 << 16
    assert sum(sum(b.column("n").to_pylist()) for b in found) == 3 * 150_002
    assert sum(sum(b.column("n_target").to_pylist()) for b in found) == 3 * 150_000


@pytest.mark.parametrize("bits", [0, 3])
def test_packed_counts_are_those_of_all_batches(bits):
    rng = np.random.default_rng(bits)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 900, 400)) for _ in range(40)]
    batches = [pa.RecordBatch.from_pydict({"text": texts[i : i + 20], "target": [k % 2 for k in range(20)]}) for i in (0, 20)]
    wanted, rows = {}, [r for b in batches for r in list(_packed(bits)([b]))]
    for b in batches:
        for part in _counts([b]):
            for kind, key, n, n_target in zip(*(c.to_pylist() for c in part.columns), strict=True):
                have = wanted.get((kind, key), (0, 0))
                wanted[kind, key] = (have[0] + n, have[1] + n_target)
    table, found = pa.Table.from_batches(rows), {}
    for kind, bucket in sorted(set(zip(table["kind"].to_pylist(), table["bucket"].to_pylist(), strict=True))):
        assert bucket < 1 << bits
        of = _total(table.filter(pc.and_(pc.equal(table["kind"], kind), pc.equal(table["bucket"], bucket))))
        found |= {(kind, key): (n, t) for kind, key, n, t in zip(*(c.to_pylist() for c in of.columns), strict=True)}
    assert found == {k: v for k, v in wanted.items() if k[0] == 0 or v[0] > 1}


def test_a_key_goes_once_each_way_for_all_tokens_that_ask(documents, frame):
    text = " ".join(f"w{k % 500} w{k % 250}" for k in range(50_000))
    batch = pa.RecordBatch.from_pydict({"at_file": [1, 1], "at_row": [7, 8], "doc_id": [1, None], "text": [text, None], "target": pa.array([1, 0], pa.int32())})
    rows = pa.Table.from_batches(list(_packed(0, texts=True)([batch])))
    assert rows.nbytes < 4 * 100_000 and rows["kind"].to_pylist()[0] == TEXTS
    answers = [_answers(rows.filter(pc.equal(rows["kind"], k))) for k in range(-1, 3)]
    assert sum(a.nbytes for a in answers) < 4 * 100_000
    n = [sum(int(_from_planes(c).sum()) for c in a.filter(pc.equal(a["kind"], k))["n"]) for k, a in enumerate(answers[1:])]
    assert n == [100_000] * 3
    rows = score(targets(documents([(1, text), (2, None), (3, text), (4, "alone")]), frame([(1, 1, 0)], LABELS)), 0).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in rows) == [(1, 100_000), (2, 0), (3, 100_000), (4, 1)]


def test_written_stages_leave_no_shuffle_files(spark):
    files = spark._jsparkSession.sparkContext().env().blockManager().diskBlockManager()
    count = lambda: sum(f.getName().endswith(".data") for f in map(files.getAllFiles().apply, range(files.getAllFiles().size())))
    before, rows = count(), spark.range(20_000).groupBy((F.col("id") % 700).alias("k")).count()
    assert staged(rows, "released").count() == 700 and spark.conf.get(RELEASE) != "true"
    ends = time.time() + 20
    while count() > before + 6 and time.time() < ends:
        time.sleep(0.2)
    # What counting the 700 rows shuffled, if anything.
    assert count() <= before + 6
