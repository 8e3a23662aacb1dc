import random

from tidemark.llm.line_dedup import align, dedup_lines, shared_blocks


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_in_order_and_longest_where_lines_are_unique():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(30) for _ in range(rng.randrange(14))] for _ in range(2))
        found = align(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found[:-1], found[1:], strict=True))
        if len(set(a)) == len(a) and len(set(b)) == len(b):
            assert len(found) == lcs(a, b)


def test_only_runs_of_some_length_are_shared():
    assert shared_blocks([1, 2, 3, 9], [5, 1, 2, 6, 9], [9, 30, 30, 9, 9], 40) == [1, 2]


def line(i):
    return f"line number {i} with quite a few words in it to be long"


def brute(pairs, rare=8):
    rows = sorted((d is None, d or 0, k, t) for k, (d, t) in enumerate(pairs))
    split = [[x.lower() for x in (t or "").split("\n") if x.strip(" \t\r\x0b\x0c")] for *_, t in rows]
    holders = {}
    for k, own in enumerate(split):
        for x in dict.fromkeys(own):
            if len(x.encode()) >= 24:
                holders.setdefault(x, []).append(k)
    out = {}
    for k, own in enumerate(split):
        others = {h for x in own for h in (holders.get(x, []) if len(holders.get(x, [])) <= rare else holders[x][:1]) if h < k}
        gone = {j for o in others for j in shared_blocks(split[o], own, [len(x.encode()) for x in own])}
        out[rows[k][1] if not rows[k][0] else None] = (len(own), len(gone), [x for j, x in enumerate(own) if j not in gone])
    return out


def test_same_as_brute_force(documents):
    rng, pairs = random.Random(5), []
    for i in range(60):
        own = [line(rng.randrange(4000)) for _ in range(rng.randrange(6))]
        if rng.random() < 0.5:
            at = rng.randrange(40)
            own += [line(10_000 + at + k) for k in range(rng.randrange(1, 5))]
        if rng.random() < 0.4:
            own.insert(rng.randrange(len(own) + 1), "A LINE THAT very many of the documents hold, a third")
        if rng.random() < 0.5:
            own.insert(rng.randrange(len(own) + 1), " \t")
        pairs.append((i, "\n".join(own)))
    expected = brute(pairs)
    rows = dedup_lines(documents(pairs)).collect()
    assert len(rows) == len(pairs) and sum(r.n_deleted for r in rows) > 20
    for r in rows:
        left = [x.lower() for x in r.text.split("\n") if x.strip(" \t")]
        assert (r.n_lines, r.n_deleted, left) == expected[r.doc_id]


def brute_all(pairs):
    """Lines deleted by alignment of all pairs of documents."""
    split = [t.split("\n") for _, t in pairs]
    return {i: len({j for o in split[:k] for j in shared_blocks(o, own, [len(x) for x in own])}) for k, ((i, _), own) in enumerate(zip(pairs, split, strict=True))}


def test_blocks_of_short_lines(documents):
    rng = random.Random(8)
    block = [f"item {k}" for k in range(100)]
    pairs = [(i, "\n".join([f"own {rng.random():.6f}" for _ in range(i)] + block[10 * i : 100 - 5 * i])) for i in range(5)]
    pairs += [(5, "\n".join(block[:3]))]
    expected = brute_all(pairs)
    assert expected[1] == 85 and expected[5] == 0
    assert {r.doc_id: r.n_deleted for r in dedup_lines(documents(pairs)).collect()} == expected


def test_a_common_block_whose_lines_have_other_first_holders(documents):
    a, b, c = "a" * 30, "b" * 30, "c" * 45
    pairs = [(1, a + "\nx"), (2, "y\n" + b), (3, c)] + [(i, f"own {i}\n{a}\n{b}\nown too {i}\n{c}\nd") for i in range(4, 60)]
    expected = brute_all(pairs)
    assert expected[4] == 1 and expected[59] == 4
    assert {r.doc_id: r.n_deleted for r in dedup_lines(documents(pairs)).collect()} == expected


def test_edge_rows(documents, frame):
    pairs = [(1, line(1)), (1, line(1)), (None, line(1)), (2, None), (3, ""), (4, "\n\n"), (5, "x" * 100_000), (6, "x" * 100_000 + "\n" + line(7)), (0, line(1).upper())]
    rows = dedup_lines(documents(pairs)).collect()
    assert len(rows) == len(pairs)
    assert sorted(r.n_deleted for r in rows if r.doc_id in (0, 1, None)) == [0, 1, 1, 1]
    by_id = {r.doc_id: r.text for r in rows}
    assert by_id[2] is None and by_id[3] == "" and by_id[4] == "\n\n" and by_id[6] == line(7) and by_id[0] == line(1).upper()
    assert dedup_lines(documents([])).collect() == []
    clash = frame([(1, line(1), 2, 3, 4), (2, line(1), 2, 3, 4)], "doc_id long, text string, lines int, first int, gone int")
    assert sorted(r.n_deleted for r in dedup_lines(clash).collect()) == [0, 1]
