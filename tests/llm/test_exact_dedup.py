import hashlib
import random

import pytest

from tidemark.llm.exact_dedup import absorb, dedup, fingerprints

SPACE = " \t\n\x0b\x0c\r"


def brute(pairs):
    groups = {}
    for doc, text in pairs:
        plain = "".join(c for c in text or "" if c not in SPACE)
        groups.setdefault(plain, []).append((-len(text or ""), doc is None, doc or 0, doc))
    out = []
    for plain, rows in groups.items():
        rows.sort(key=lambda r: r[:3])
        sha = hashlib.sha256(plain.encode()).hexdigest()
        out += [(r[3], rows[0][3], len(rows), k == 0, sha) for k, r in enumerate(rows)]
    return sorted(out, key=str)


def found(docs, **options):
    return sorted((tuple(r) for r in dedup(docs, **options).drop("at_file", "at_row").collect()), key=str)


PAIRS = [
    (1, "a b"), (2, "ab"), (3, "a  b"), (4, "a b"), (5, None), (6, ""), (7, " "), (None, "a   b"), (9, "x" * 200_000), (9, "x" * 200_000),
    (8, "x" * 200_000), (-5, "é"), (-6, "é"), (2**63 - 1, "é "), (-(2**63), "z"),
]


def test_same_as_brute_force(documents):
    assert found(documents(PAIRS)) == brute(PAIRS)
    assert found(documents([])) == []


@pytest.mark.parametrize("digest_bytes", [0, 1])
def test_texts_under_one_digest_are_told_apart(documents, digest_bytes):
    rng = random.Random(digest_bytes)
    pairs = PAIRS + [(i, f"t{rng.randrange(200)}" + " " * rng.randrange(3)) for i in range(10, 400)]
    assert found(documents(pairs), digest_bytes=digest_bytes) == brute(pairs)


def test_state_goes_on_with_later_arrivals(spark, documents, tmp_path):
    feed, state = f"{tmp_path}/feed", f"{tmp_path}/state"
    for part, sizes in (([(1, "a"), (2, "b")], {1: 1, 2: 1}), ([(3, "a"), (0, " b")], {1: 2, 0: 2})):
        fingerprints(documents(part)).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(spark.read.parquet(feed).schema).parquet(feed)
        rows = absorb(stream, state).selectExpr("~best.doc_id AS id", "group_size").collect()
        assert {r.id: r.group_size for r in rows} == sizes


def test_extra_columns_may_clash(frame):
    rows = frame([(1, "a", 1, 2, 3), (2, "a", 1, 2, 3)], "doc_id long, text string, digest int, sha int, group_size int")
    assert [r[:4] for r in found(rows)] == [(1, 1, 2, True), (2, 1, 2, False)]


def test_no_python_in_the_plan(documents):
    plan = dedup(documents(PAIRS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
