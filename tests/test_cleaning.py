import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning as c
from tidemark.operators.joins import lookup, mark_known, matching
from tidemark.operators import quality
from tidemark.operators.quality import null_profile, quality_report, quality_rules
from tidemark.spec import Rule

AT = datetime(2024, 1, 1)


def skewed(n=3000, seed=1):
    """A third of the rows share one key, a third of those are equal; some keys are null."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        if i % 3 == 0:
            out.append((7, 1, "same") if i % 9 == 0 else (7, r.randrange(50), f"v{r.randrange(20)}"))
        else:
            key = None if i % 7 == 0 else r.randrange(200)
            out.append((key, r.randrange(5), f"v{r.randrange(3)}"))
    return out


def brute_survivors(rows):
    best = {}
    for row in rows:
        if row[0] not in best or (row[1], row[2]) > (best[row[0]][1], best[row[0]][2]):
            best[row[0]] = row
    return list(best.values())


def test_dedup_and_rejects_split_the_rows(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "k int, ts int, v string").repartition(5)
    kept = [tuple(r) for r in c.dedup(df, ["k"], ["ts"]).collect()]
    gone = [tuple(r) for r in c.duplicate_rejects(df, ["k"], ["ts"]).collect()]
    assert Counter(kept) == Counter(brute_survivors(rows))
    assert Counter(kept) + Counter(gone) == Counter(rows)


def test_rejects_of_crowded_keys_and_others_are_the_same(spark):
    rows = skewed() + [(-1, 1, "x"), (-1, 1, "x"), (-1, 2, None), (-1, 2, None)]
    df = spark.createDataFrame(rows, "k int, ts int, v string").repartition(5)
    found = [Counter(map(tuple, c.duplicate_rejects(df, ["k"], ["ts"], ("same", "other"), crowd).collect())) for crowd in (1, 3, 10**6)]
    assert found[0] == found[1] == found[2] and found[0][-1, 2, None, "same"] == 1 and found[0][-1, 1, "x", "other"] == 2
    assert Counter(r[:3] for r in found[0].elements()) + Counter(map(tuple, c.dedup(df, ["k"], ["ts"]).collect())) == Counter(rows)


def test_rejects_are_shuffled_once(spark):
    """Before, rows went through three shuffles and a join."""
    df = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    plan = c.duplicate_rejects(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_equal_zeros_of_unlike_sign_lose_one_row_only(spark):
    """Before, each sign had a best row of its own, and none was rejected."""
    df = spark.createDataFrame([(1, -0.0), (1, 0.0)], "k int, x double")
    assert c.duplicate_rejects(df, ["k"]).count() == 1


def test_dedup_does_not_depend_on_row_order(spark):
    rows = skewed()
    random.Random(3).shuffle(rows)
    again = spark.createDataFrame(rows, "k int, ts int, v string").repartition(3)
    assert Counter(tuple(r) for r in c.dedup(again, ["k"], ["ts"]).collect()) == Counter(brute_survivors(skewed()))


def test_dedup_keeps_map_columns(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2})], "k int, m map<string,int>")
    assert [r.m for r in c.dedup(df, ["k"]).collect()] == [{"a": 2}]


def test_expand_copies_in_chunks(spark):
    df = spark.createDataFrame([("a", 10), ("b", 0), ("c", 3)], "v string, n bigint")
    assert Counter(r.v for r in c.expand_copies(df, "n", chunk=4).collect()) == {"a": 10, "c": 3}


def test_null_strategies_in_order(spark, rows):
    df = spark.createDataFrame([(1, None, ""), (None, "x", None)], "a int, b string, c string")
    kept, excluded = c.apply_null_strategies(
        df,
        {"a": ("excluir", None), "b": ("imputar", "none"), "c": ("indicador", None), "zz": ("indicador", None)},
    )
    assert rows(kept) == [{"a": 1, "b": "none", "c": "", "_nulo_c": 0}]
    assert rows(excluded) == [{"a": None, "b": "x", "c": None, "_nulo_c": 1}]


def test_fill_of_the_wrong_type_changes_nothing(spark):
    df = spark.createDataFrame([(None,)], "a int")
    assert c.fill_nulls(df, {"a": "text"}).first()["a"] is None
    assert c.fill_nulls(df, {"a": "5"}).first()["a"] == 5


def test_mask_keeps_the_type(spark):
    df = spark.createDataFrame([(1.5, "x")], "price double, v string")
    masked = c.mask_null(df, ["price", "absent"])
    assert masked.schema["price"].dataType.simpleString() == "double"
    assert masked.first().asDict() == {"price": None, "v": "x", "_price_enmascarado": 1}


@pytest.fixture()
def fact(spark):
    return spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 99)], "id int, fk bigint")


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame([(10,), (20,), (20,), (None,)], "pk bigint")


def test_foreign_keys(fact, dim, rows):
    assert [r["id"] for r in rows(c.fk_valid(fact, dim, "fk", "pk"))] == [1, 2]
    orphans = rows(c.fk_orphans(fact, dim, "fk", "pk", "d"))
    assert [r["id"] for r in orphans] == [3, 4] or {r["id"] for r in orphans} == {3, 4}
    assert orphans[0]["motivo_error"] == "FK_INVALIDA: fk no existe en d"
    good, bad = c.fk_split(fact, dim, "fk", "pk")
    assert {r.id for r in good.collect()} == {1, 2} and {r.id for r in bad.collect()} == {3, 4}


def test_lookup_never_matches_a_hashed_null(spark):
    """The hash that stands in for a null key may equal a real key; it must not match."""
    fact = spark.createDataFrame([(1, None), (2, 5)], "id int, fk bigint")
    stand_in = fact.select(F.xxhash64("id").alias("h")).collect()
    dim = spark.createDataFrame([(stand_in[0].h, "wrong"), (5, "right")], "pk bigint, name string")
    assert {r.id: r.name for r in lookup(fact, dim, "fk", "pk").collect()} == {1: None, 2: "right"}


@pytest.mark.parametrize("kind", ["bigint", "int", "string", "date"])
def test_lookup_with_many_null_keys(spark, kind):
    text = {"date": "'2024-01-01'"}.get(kind, "'5'")
    fact = spark.range(300).selectExpr("id", f"CASE WHEN id % 3 > 0 THEN CAST({text} AS {kind}) END AS fk")
    dim = spark.sql(f"SELECT CAST({text} AS {kind}) AS pk, 'hit' AS name")
    found = lookup(fact, dim, "fk", "pk").groupBy("name").count().collect()
    assert {r.name: r["count"] for r in found} == {None: 100, "hit": 200}


def test_matching_is_null_safe(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "id int, g string")
    keys = spark.createDataFrame([(None,), ("a",), ("a",)], "g string")
    assert {r.id for r in matching(df, keys, ["g"]).collect()} == {1, 2}


def test_mark_known_same_name(fact, spark):
    dim = spark.createDataFrame([(10,)], "fk bigint")
    assert {r.id: r.ok for r in mark_known(fact, dim, "fk", "fk", "ok").collect()} == {1: True, 2: False, 3: False, 4: False}


def test_split_puts_each_row_in_one_place(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,), (None,)], "n int")
    good, bad = c.split_by_rule(df, F.col("n") < 0, "NEG")
    assert {r.n for r in good.collect()} == {0, 1, None}
    assert [tuple(r) for r in bad.collect()] == [(-1, "NEG")]


def test_null_out_keeps_the_row_and_a_copy(spark):
    df = spark.createDataFrame([(1, -5.0), (2, 5.0), (3, None)], "id int, w double")
    kept, copies = c.null_out_invalid(df, "w", F.col("w") < 0, "NEG")
    assert {r.id: r.w for r in kept.collect()} == {1: None, 2: 5.0, 3: None}
    assert [(r.id, r.w) for r in copies.collect()] == [(1, -5.0)]


def test_quarantine_payload(spark):
    df = spark.createDataFrame([(1, None, "ñ")], "id int, gone string, v string")
    row = c.quarantine(df, "t", AT, "WHY").first()
    assert (row.tabla_origen, row.motivo_error, row.ts_error, row.payload) == ("t", "WHY", AT, '{"id":1,"v":"ñ"}')


RULES = [
    Rule("set", lambda: F.col("a").isNotNull(), True),
    Rule("positive", lambda: F.col("a") > 0),
    Rule("missing", lambda: F.col("zz") > 0, True),
]


def test_rules(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,), (2,)], "a int")
    got = {r.prueba: (r.aprobada, r.n_fallos, r.pct_fallo, r.estado) for r in quality_rules(df, "t", RULES, AT).collect()}
    assert got["set"] == (False, 1, 25.0, "FALLIDA")
    assert got["positive"] == (False, 1, 25.0, "ADVERTENCIA")
    assert got["missing"] == (False, 0, 0.0, "ERROR")
    strict = {r.prueba: r.n_fallos for r in quality_rules(df, "t", RULES, AT, null_fails=True).collect()}
    assert strict["positive"] == 2


def test_rules_on_no_rows(spark):
    df = spark.createDataFrame([], "a int")
    got = {r.prueba: (r.aprobada, r.pct_fallo) for r in quality_rules(df, "t", RULES[:2]).collect()}
    assert got == {"set": (True, 0.0), "positive": (True, 0.0)}


def test_profile_and_report(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, _b string")
    assert [tuple(r) for r in null_profile(df).collect()] == [("a", 1, 33.33)]
    row = quality_report(df, df.filter("a is not null"), "t", "b", AT, 2, 1).first()
    assert (row.n_registros_bronze, row.n_registros_silver, row.n_duplicados, row.n_rechazados) == (3, 2, 2, 1)
    assert row.pct_conformes == 66.67 and row.detalle_nulos == '{"a":0.0}'
    assert quality_report(df.filter("1=0"), df.filter("1=0"), "t", "b", AT, 0, 0).first().pct_conformes == 0.0


def test_rejected_duplicates_keep_maps_and_the_sign_of_zero(spark):
    rows = spark.createDataFrame(
        [(1, {"a": 1}, -0.0), (1, {"a": 1}, -0.0), (1, {"a": 0}, 5.0), (2, None, 1.0), (None, None, None), (None, None, None)],
        "k int, m map<string,int>, x double",
    )
    gone = c.duplicate_rejects(rows, ["k"], reasons=("same", "other")).collect()
    found = sorted(((r.k, r.m, str(r.x), r.motivo_error) for r in gone), key=str)
    # The map is compared as text, after the plain columns.
    assert found == sorted([(1, {"a": 1}, "-0.0", "other"), (1, {"a": 1}, "-0.0", "other"), (None, None, "None", "same")], key=str)


def test_no_rules_and_rules_that_fail_while_running(spark):
    rows = spark.createDataFrame([("1",), ("x",)], "v string")
    assert quality_rules(rows, "t", []).columns == list(quality.RULE_COLUMNS) and quality_rules(rows, "t", []).isEmpty()
    rules = [Rule("cast", lambda: F.col("v").cast("int") > 0, True), Rule("filled", lambda: F.col("v").isNotNull())]
    found = {r.prueba: (r.aprobada, r.n_fallos, r.estado) for r in quality_rules(rows, "t", rules).collect()}
    assert found == {"cast": (False, 0, "ERROR"), "filled": (True, 0, "APROBADA")}


def test_null_keys_of_any_type_are_spread(spark):
    rows = spark.range(1000).select("id", F.lit(None).cast("date").alias("k"))
    dim = spark.createDataFrame([(None, 1)], "k date, v int").unionByName(spark.sql("SELECT DATE '2024-01-01' AS k, 2 AS v"))
    joined = lookup(rows.hint("merge"), dim.hint("merge"), "k")
    assert joined.count() == 1000 and joined.filter("v IS NOT NULL").isEmpty()
    assert joined.select(F.spark_partition_id()).distinct().count() > 1 or spark.conf.get("spark.sql.adaptive.enabled") == "true"


# ---- counts taken while rows are written ------------------------------------------------------------------------------

def test_watched_counts_equal_separate_passes(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i % 3 else i, "x" if i % 4 else None) for i in range(100)], "a int, b int, c string")
    rules = [
        Rule("b", lambda: F.col("b") < 50, True), Rule("c", lambda: F.col("c").isNotNull()), Rule("none", lambda: F.col("zz") > 0),
        Rule("only good rows are tried", lambda: F.when(F.col("a") < 90, F.lit(True)).otherwise(F.raise_error(F.lit("x")).isNull())),
    ]
    good = F.col("a") < 90
    watched = quality.Watched(rows, "t", rules, good, sum=F.sum("a"))
    watched.frame.repartition(7).write.parquet(f"{tmp_path}/out")
    kept = rows.filter(good)
    assert watched.count("sum") == 4950 and spark.read.parquet(f"{tmp_path}/out").count() == 100
    assert watched.verdicts(AT).collect() == quality_rules(kept, "t", rules, AT).collect()
    assert watched.report("b", AT, 100, 3, 7).collect() == quality_report(rows, kept, "t", "b", AT, 3, 7).collect()
    empty = quality.Watched(rows.filter("a < 0"), "t", rules, good, sum=F.sum("a"))
    empty.frame.write.parquet(f"{tmp_path}/empty")
    assert empty.count("sum") == 0 and empty.verdicts().collect()[0].pct_fallo == 0.0


def test_only_a_rules_own_failure_is_its_verdict(spark, tmp_path):
    rows = spark.createDataFrame([(1, "1"), (2, "x")], "a int, s string")
    rules = [Rule(f"r{i}", lambda: F.col("a") > 1) for i in range(5)]
    rules[3:3] = [Rule("cast", lambda: F.col("s").cast("int") > 0), Rule("zero", lambda: 1 / (F.col("a") - 1) > 0, True)]
    found = {r.prueba: (r.n_fallos, r.estado) for r in quality_rules(rows, "t", rules, AT).collect()}
    assert found["cast"] == found["zero"] == (0, "ERROR") and len(found) == 7
    assert all(found[f"r{i}"] == (1, "ADVERTENCIA") for i in range(5))
    # A frame that can't be read is nobody's verdict.
    (tmp_path / "junk.parquet").write_text("junk")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        quality_rules(spark.read.schema("a int").parquet(f"{tmp_path}/junk.parquet"), "t", rules[:2], AT)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        quality_rules(rows.filter(F.col("s").cast("int") > 0), "t", rules[:2], AT)


def test_counted_dedup_keeps_what_dedup_keeps(spark):
    rows = spark.createDataFrame(
        [(1, 5, "a", {"m": 1}), (1, 7, "b", None), (1, 7, "c", {"m": 2}), (2, None, "a", None), (2, None, "a", None), (None, 1, "z", None)],
        "k int, t int, v string, m map<string,int>",
    )
    found = c.counted_dedup(rows, ["k"], ["t"])
    counts = {r.k: r._copias for r in found.collect()}
    assert counts == {1: 3, 2: 2, None: 1}
    as_rows = lambda df: sorted(map(str, df.collect()))
    assert as_rows(found.drop("_copias")) == as_rows(c.dedup(rows, ["k"], ["t"]))
