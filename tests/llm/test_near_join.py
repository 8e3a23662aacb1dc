"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import near_join, tokens
from tidemark.llm.near_join import near_groups, signatures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(pairs):
    sets = [shingles(t) for _, t in pairs]
    group = list(range(len(pairs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                group[root(i)] = root(j)
    low = {}
    for i, (doc, _) in enumerate(pairs):
        if doc is not None:
            low[root(i)] = min(low.get(root(i), doc), doc)
    return sorted(
        ((d, len(s), low.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(pairs, sets, strict=True))), key=str
    )


def found(docs, **options):
    return sorted((tuple(r) for r in near_groups(docs, **options).drop("at_file", "at_row", "group").collect()), key=str)


@pytest.mark.parametrize("least", [2, 5, 1000])
def test_same_groups_as_all_pairs(documents, speak, least, monkeypatch):
    monkeypatch.setattr(near_join, "BLOCK_ROWS", 4)
    if least == 5:
        monkeypatch.setattr(near_join, "BROADCAST_BYTES", -1)
    rng, pairs = random.Random(least), []
    passage = speak(60)
    for base in range(6):
        words = speak(rng.choice([3, 5, 12, 90, 300, 700]))
        for _ in range(rng.choice([1, 3, 25])):
            own = list(words)
            for _ in range(rng.randrange(1 + len(own) // 25)):
                i = rng.randrange(len(own))
                own[i : i + rng.randrange(2)] = speak(rng.randrange(3))
            if rng.random() < 0.4:
                own += passage
            pairs.append((len(pairs), " ".join(own)))
    pairs += [(len(pairs) + i, " ".join(speak(40) + passage)) for i in range(15)]
    assert found(documents(pairs), least=least) == brute(pairs)


def test_pairs_near_the_threshold_do_not_grow_with_the_square_of_a_group(documents, speak, monkeypatch):
    """Copies of 139 shingles, of which two edits each change ten: two copies differ in 20 on either side, and 19 would be a link."""
    rng, words, pairs, compared = random.Random(4), speak(143, 10**7), [], []
    for k in range(70):
        own = list(words)
        for i in (rng.randrange(5, 65), rng.randrange(75, 135)):
            own[i] = f"e{k}x{i}"
        pairs.append((k, " ".join(own)))
    once = near_join.compared

    def counted(docs, classes, wanted):
        compared.append(wanted.count())
        return once(docs, classes, wanted)

    monkeypatch.setattr(near_join, "compared", counted)
    assert found(documents(pairs)) == brute(pairs)
    assert max(compared) <= 8 * len(pairs)


def test_lists_with_the_same_members_go_to_a_task_once(spark, monkeypatch):
    """Forty lists of a passage's holders, each without one of them, and ten that only share their smallest member."""
    monkeypatch.setattr(near_join, "BLOCK_ROWS", 16)
    lists = {sign: [x for x in range(41) if x != sign + 1] for sign in range(40)} | {100 + k: [500, 501 + k] for k in range(10)}
    rows = [(sign, 9, x, 50, 1000 + x, min(own), len(own), 50 * len(own)) for sign, own in lists.items() for x in own]
    rows = spark.createDataFrame(rows, "sign long, sizes long, id long, n long, label long, hub long, held long, sum long")
    met = near_join._met(rows, rows.select("sign", "sizes", "hub", "held", "sum").distinct()).collect()
    meet = {}
    for r in met:
        meet.setdefault(r["sign"], set()).add(r["id"])
    for own in lists.values():
        assert all(any({x, y} <= members for members in meet.values()) for x in own for y in own)
    # Members are in as many blocks as there are chunks of 16 of all of them, not of each list.
    assert len(met) == 3 * 41 + 20
    # A block of many members is a task's work; lists of a hub that aren't one list are work of one task together.
    assert len({(r["unit"], r["id"]) for r in met}) == 3 * 41 + 11


def test_edge_rows(documents, speak):
    words = speak(30)
    pairs = [
        (9, None), (8, ""), (7, " \t\n"), (6, "One two"), (5, "one\x0btwo"), (4, "x" * 100_000), (None, " ".join(words)), (3, " ".join(words)),
        (3, " ".join(words)), (2, " ".join(words).upper()), (None, "alone"), (1, " ".join(speak(30_000))),
    ]
    assert found(documents(pairs)) == brute(pairs)
    assert found(documents([])) == []


def test_extra_columns_may_clash(frame):
    schema = "doc_id long, text string, n int, class string, at_file string, id int, label int, segment int"
    rows = [(1, "a b c d e f", 1, "c", "f", 1, 2, 3), (2, "a b c d e f", 1, "c", "f", 1, 2, 3)]
    assert found(frame(rows, schema)) == [(1, 2, 1), (2, 2, 1)]


def test_sets_within_the_threshold_share_a_signature():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 4, 7, 50, 63, 64, 100, 128, 170, 171, 255, 256, 700):
        for _ in range(8):
            pool = np.unique(rng.integers(0, 2**63, 2 * n + 2, dtype=np.int64)).astype(np.uint64)
            df = rng.random(len(pool)) < rng.choice([0, 0.5, 0.95, 1])
            a = np.sort(rng.permutation(len(pool))[:n])
            while True:
                gone, new = rng.integers(0, n // 4 + 1), rng.integers(0, n // 4 + 1)
                b = np.union1d(rng.permutation(a)[gone:], np.setdiff1d(np.arange(len(pool)), a)[:new])
                both = len(np.intersect1d(a, b))
                if 100 * both >= 75 * (len(a) + len(b) - both):
                    break
            assert len(np.intersect1d(signatures(pool[a], df[a]), signatures(pool[b], df[b])))


def test_a_sketch_never_bounds_too_low():
    import numpy as np

    from tidemark.llm.near_join import _sketch, most_shared

    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 8, 15, 16, 100, 127, 128, 500):
        for m in {max(1, n * 3 // 4), n, n + n // 3}:
            pool = rng.integers(0, 2**63, n + m, dtype=np.int64).astype(np.uint64)
            for shared in (0, min(n, m) // 2, min(n, m)):
                a, b = pool[:n], np.concatenate((pool[:shared], pool[n : n + m - shared]))
                most = most_shared(_sketch(a), _sketch(b), n, m)
                assert shared <= most <= min(n, m)
                assert n < 100 or shared or most < 0.6 * n


def test_tokens_equal_their_definition():
    """Words, shingles and distinct sets of whole columns, against sums over single bytes; short, empty and null texts lie between others."""
    column = pa.array(["a b  c d e f", None, "", "Long" * 9 + "\tx", "y", " é漢 z.", "q " * 20])
    step, mask = int(tokens._STEP), 2**64 - 1
    value = lambda w: sum(int(tokens.SPACED[1][b]) * pow(step, k + 1, 2**64) for k, b in enumerate(w)) & mask
    mixed = lambda x: int(tokens.mix(np.array([x & mask], np.uint64))[0])
    texts = [[mixed(value(w.encode())) for w in (t or "").split()] for t in column.to_pylist()]
    found, at = tokens.words(column)
    assert [found[a:b].tolist() for a, b in zip(at, at[1:])] == texts
    runs, starts = tokens.shingles(found, at, 5)
    for own, words, a, b in zip(tokens.distinct(runs, starts), texts, starts[:-1], starts[1:], strict=True):
        parts = [words[i : i + 5] for i in range(max(1, len(words) - 4))] if words else []
        made = []
        for part in parts:
            out = len(part)
            for word in part:
                out = mixed(out * int(tokens._MUL) + word)
            made.append(out)
        assert runs[a:b].tolist() == made and own.tolist() == sorted(set(made))
    # A text longer than a piece has no table of powers and gets the same hashes.
    long = pa.array(["a b " + "c " * (tokens.PIECE + 9)])
    assert tokens.words(long)[0][:3].tolist() == [mixed(value(w)) for w in (b"a", b"b", b"c")]
