import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm.infill import LINE, infill, restored


def expected(doc_id, text, percent=100, spm=50):
    """By hand: (n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(LINE, text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def made(df):
    rows = df.withColumn("again", restored(F.col("output"), F.col("form"))).collect()
    return sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again) for r in rows], key=repr)


def wanted(pairs, **rates):
    return sorted([(i, *expected(i, t, **rates), t or "") for i, t in pairs], key=repr)


@pytest.fixture()
def texts():
    rng = random.Random(3)
    ends = ["\n", "\n\n", "\r\n", " ", "<", "<S", "$1", "\\", "é", "😀", " ", "\x00", "P>", "S>x", "\x85"]
    return [(i, "".join(rng.choice(ends + ["abc", "der Weg"]) for _ in range(rng.randrange(1, 40)))) for i in range(400)]


def test_cuts_outputs_and_round_trip(documents, texts):
    assert made(infill(documents(texts))) == wanted(texts)
    assert {f for _, _, f, *_ in wanted(texts)} >= {"psm", "spm"}


def test_rates(documents, texts):
    found = made(infill(documents(texts), percent=60, spm=20))
    assert found == wanted(texts, percent=60, spm=20)
    assert {f for _, _, f, *_ in found} == {"plain", "psm", "spm"}


def test_nulls_empty_repeats_marks(documents):
    pairs = [(1, None), (2, ""), (3, "\n"), (3, "\n"), (None, "a\nb\nc"), (None, None), (4, "x<M>y\nz"), (5, "<S\nP>"), (6, "a" * 9)]
    assert made(infill(documents(pairs))) == wanted(pairs)


def test_very_long_texts(documents):
    pairs = [(1, "x\n" * 1_000_000), (2, "y" * 3_000_000), (3, "é\n" * 100_000 + "z" * 1_000_000), (4, "\n" * 500_000)]
    assert made(infill(documents(pairs))) == wanted(pairs)


def test_other_units_and_marks(documents):
    marks = ("[PRE]", "$SUF", "\\MID")
    pairs = [(i, "one two  three\tfour") for i in range(20)]
    got = infill(documents(pairs), unit=r"\S+\s*", marks=marks)
    rows = got.withColumn("again", restored(F.col("output"), F.col("form"), marks)).collect()
    assert [(r.n, r.again) for r in rows] == [(4, t) for _, t in pairs]
    assert {r.output[:4] for r in rows} <= {"[PRE", "$SUF"}
    assert all(sum(len(m) for m in marks) == len(r.output) - len(pairs[0][1]) for r in rows)


def test_marks_that_could_be_misread(documents):
    with pytest.raises(ValueError):
        infill(documents([]), marks=("<<", "<S>", "<M>"))
    with pytest.raises(ValueError):
        infill(documents([]), marks=("<P>", "<P>", "<M>"))


def test_empty_and_clashing(documents, frame):
    assert infill(documents([])).collect() == []
    rows = frame([(1, "a\nb", 7, "f", "o", 1)], "doc_id long, text string, n int, form string, output string, first int")
    assert made(infill(rows)) == wanted([(1, "a\nb")])


def test_plan_has_no_shuffle_and_no_python(documents):
    plan = infill(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Arrow" not in plan and "Python" not in plan
