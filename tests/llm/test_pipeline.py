"""The stages one by one against brute force, each on the rows that the one before kept."""

import random

import pytest
from test_decontaminate import brute as hits
from test_exact_dedup import brute as copies
from test_near_join import brute as groups

import __spark_entry__ as entry_points
import corpus_pipeline
from tidemark.llm.packing import pack
from tidemark.llm.queries import QUERIES


@pytest.fixture()
def folder(spark, tmp_path, speak):
    rng, docs, labels = random.Random(8), [], []
    items = [(k, " ".join(speak(30))) for k in range(5)]
    for i in range(500):
        own = speak(rng.choice([8, 60, 150]))
        bad = rng.random() < 0.2
        if bad:
            own = [w.upper() + "!!" for w in own]
        elif docs and rng.random() < 0.3:
            own = rng.choice([d for d in docs if not d[4]])[1].split()
            if rng.random() < 0.6 and len(own) > 50:
                own[rng.randrange(len(own))] = "other"
        elif rng.random() < 0.1:
            own += items[rng.randrange(5)][1].split()
        docs.append((i, "  ".join(own), "en", f"s{i % 3}", bad))
        labels.append((i, int(not bad), 0))
    docs += [(None, None, None, None, False), (7, "", "en", "s", False), (7, docs[7][1], "en", "s", docs[7][4])]
    spark.createDataFrame([(*d[:4], None) for d in docs], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels[::2], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), items, {(d[0], d[1]) for d in docs if d[4]}


def plain(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages(spark, folder, tmp_path):
    sf_dir, items, bad = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = plain(docs)
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = before, plain(docs)
    before, after = kept["quality"]
    wrong = [r for r in before if (r in after) == (r in bad) and r[1]]
    assert len(wrong) < 0.03 * len(before)
    before, after = kept["exact_dedup"]
    assert sorted(i for i, *_ in after if i is not None) == sorted(r[0] for r in copies(before) if r[3] and r[0] is not None)
    before, after = kept["near_dedup"]
    first = {c for _, n, c in groups(before) if n} | {d for d, n, _ in groups(before) if not n}
    assert {i for i, _ in after} == first and len(after) < len(before)
    before, after = kept["decontaminate"]
    clean = sorted((r[0] for r in hits(before, items) if not r[5]), key=str)
    assert sorted((i for i, _ in after), key=str) == clean and len(after) < len(before)
    last = sorted(map(str, corpus_pipeline.packed(spark, docs, sf_dir).collect()))
    assert last == sorted(map(str, pack(docs).drop("at_file", "at_row").collect()))
    assert sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect())) == last


def test_empty_documents(spark, folder, tmp_path):
    sf_dir = folder[0]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert {int(n.split("_")[0][2:]) for n in QUERIES} == set(range(1, 11))
