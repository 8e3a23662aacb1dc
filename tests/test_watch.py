"""Baselines and alerts that are kept up to date from changes."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators.anomaly import rolling_baseline, rolling_update
from tidemark.plans.flow import Lakehouse
from tidemark.plans.testbed import layers
from tidemark.sources.tables import LakeTable

KEYS, FORM = ["g", "w"], "g string, w int, n bigint"


def rows(df):
    return {(r.g, r.w): (r.n, r["promedio_8_semanas"], r.pct_desviacion) for r in df.collect()}


def test_an_update_returns_all_that_changes_and_little_else(spark):
    rng = random.Random(5)
    old = {(g, w): rng.randrange(1, 9) for g in ("a", "b", None) for w in [None, *rng.sample(range(200), 60)]}
    new = dict(old)
    for key in rng.sample(sorted(old, key=str), 4):
        del new[key]
    for key in rng.sample(sorted(new, key=str), 4):
        new[key] += 5
    for key in [("a", 500), ("b", 501), ("new", 7)]:
        new[key] = 3
    touched = [k for k in old.keys() | new.keys() if old.get(k) != new.get(k)]
    frame = lambda cells: spark.createDataFrame([(*k, n) for k, n in cells.items()], FORM)
    before, after = (rows(rolling_baseline(frame(c), "n", ["g"], ["w"])) for c in (old, new))
    found = rows(rolling_update(frame(new), spark.createDataFrame(touched, "g string, w int"), "n", ["g"], ["w"]))
    assert {k: v for k, v in found.items() if v[0] is not None} == {k: after[k] for k in found.keys() & after.keys()}
    assert {k for k, v in found.items() if v[0] is None} == set(old) - set(new)
    changed = {k for k in before.keys() | after.keys() if before.get(k) != after.get(k)}
    assert changed <= set(found) and len(found) <= 9 * len(touched)


def test_an_update_without_changes_is_empty(spark):
    series = spark.createDataFrame([("a", 1, 2)], FORM)
    assert rolling_update(series, series.select(*KEYS).limit(0), "n", ["g"], ["w"]).count() == 0
    assert rolling_update(series.limit(0), series.select(*KEYS), "n", ["g"], ["w"]).collect()[0].n is None


CUSTOMERS = "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double, seen timestamp"
VISITS = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string, seen timestamp"


def day(n):
    return datetime(2024, 1, 1 + n)


@pytest.fixture()
def lake(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"), [layers.CUSTOMERS, layers.SEEN], [layers.PLACED], [layers.WEEKS, layers.OUTBREAKS])
    patients = spark.createDataFrame([(1, 7, "x", 1.0, day(0))], CUSTOMERS)
    # One visit a week for ten weeks, three in the last.
    visits = [(10 + k, 1, datetime(2024, 1, 1 + 7 * k) if k < 4 else datetime(2024, 2, 7 * k - 27), "I10", day(0)) for k in range(8)]
    visits += [(30, 1, datetime(2024, 2, 22), "I10", day(0)), (31, 1, datetime(2024, 2, 23), "I10", day(0))]
    lake.run({"customer": patients, "visits": spark.createDataFrame(visits, VISITS)}, day(1))
    return lake


def alerts(lake):
    return sorted((r.anio, r.semana, r.volumen_actual) for r in lake.gold("outbreaks").read().collect())


def test_a_correction_cancels_an_alert_without_reading_visits(lake, spark, monkeypatch):
    assert alerts(lake) == [(2024, 8, 3)]
    gone = [(30, 1, datetime(2024, 1, 3), "I10", day(2)), (31, 1, datetime(2024, 1, 4), "I10", day(2))]
    run = lake.run({"visits": spark.createDataFrame(gone, VISITS)}, day(3))
    assert alerts(lake) == []
    back = [(30, 1, datetime(2024, 2, 22), "I10", day(4)), (31, 1, datetime(2024, 2, 23), "I10", day(4))]
    lake.ingest("visits", spark.createDataFrame(back, VISITS), run)
    lake.clean("visits", run)
    lake.build_mart("placed", run)

    def refuse(table, *_):
        raise AssertionError(f"all of {table.path} is read")

    with monkeypatch.context() as patch:
        patch.setattr(LakeTable, "read", refuse)
        assert lake.build_kpi("weeks", run) == lake.build_kpi("outbreaks", run) == "EXITOSO"
    assert alerts(lake) == [(2024, 8, 3)]


def test_changes_are_not_added_twice_when_a_run_dies_before_it_notes_them(lake, spark, monkeypatch):
    more = spark.createDataFrame([(40, 1, datetime(2024, 2, 20), "I10", day(2))], VISITS)

    def die(*_):
        raise RuntimeError("killed")

    for later in (False, True):
        with monkeypatch.context() as patch:
            finish = Lakehouse._finish
            patch.setattr(Lakehouse, "_finish", lambda s, c, *a: die() if c == "gold.weeks" else finish(s, c, *a))
            lake.run({"visits": more}, day(3 + 2 * later), fail=False)
        if later:
            # More has come before the step is repeated.
            more = spark.createDataFrame([(42, 1, datetime(2024, 2, 20), "I10", day(6))], VISITS)
        lake.run({"visits": more}, day(4 + 2 * later))
        whole = lake.kpis["weeks"].rows(lake.gold("placed").read())
        columns = ["anio", "semana", "ciudad", "codigo_cie10", "volumen_actual", "_n"]
        held = lake.gold("weeks").read().select(*columns)
        assert held.exceptAll(whole.select(*columns)).isEmpty() and whole.select(*columns).exceptAll(held).isEmpty()
        assert alerts(lake) == [(2024, 8, 4 + 2 * later)]
        more = spark.createDataFrame([(41, 1, datetime(2024, 2, 20), "I10", day(5))], VISITS)
