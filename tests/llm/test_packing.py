import random
from itertools import combinations

import pytest

from tidemark.llm.packing import bounds, pack


def padding(ends, histogram):
    return sum(c * (min(e for e in ends if e >= n) - n) for n, c in histogram.items())


@pytest.mark.parametrize("buckets", [1, 2, 3, 4])
def test_no_other_bounds_pad_less(buckets):
    rng = random.Random(buckets)
    for _ in range(20):
        histogram = {n: rng.randrange(1, 9) for n in rng.sample(range(1, 40), rng.randrange(1, 9))}
        ends = bounds(histogram, buckets)
        others = [c for k in range(1, buckets + 1) for c in combinations(sorted(histogram), k) if max(c) == max(histogram)]
        assert ends == sorted(ends) and len(ends) <= buckets
        assert padding(ends, histogram) == min(padding(c, histogram) for c in others)
    assert bounds({}) == []


def test_every_word_is_packed_once(documents, speak):
    rng = random.Random(1)
    pairs = [(i, " ".join(speak(rng.choice([1, 5, 20, 64, 65, 300])))) for i in range(120)]
    pairs += [(None, "a b"), (3, "a b c"), (3, "a b c"), (500, None), (501, ""), (502, "\t\n")]
    rows = pack(documents(pairs), 64, 3, 200).collect()
    words = sum(len((t or "").split()) for _, t in pairs)
    assert sum(r.n_tokens for r in rows) == words
    batches = {}
    for r in rows:
        if r.bucket is None:
            assert (r.piece, r.n_tokens, r.batch, r.slot) == (None, 0, None, None)
            continue
        assert r.n_tokens <= r.bucket and r.start == 64 * r.piece
        batches.setdefault((r.bucket, r.batch), []).append(r.slot)
    for (bucket, batch), slots in batches.items():
        room = max(1, 200 // bucket)
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= room
        assert len(slots) == room or (bucket, batch + 1) not in batches
    assert sum(r.bucket is None for r in rows) == 3


def test_empty_and_clashing(documents, frame):
    assert pack(documents([])).collect() == []
    rows = frame([(1, "a b", 7, 8, 9)], "doc_id long, text string, bucket int, at int, piece int")
    assert [(r.doc_id, r.n_tokens, r.bucket) for r in pack(rows).collect()] == [(1, 2, 2)]
