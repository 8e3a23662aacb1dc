from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.plans.hospital import AGE_BANDS, CAUTION_OCCUPANCY, CRITICAL_OCCUPANCY, EXPECTED_DIAGNOSES
from tidemark.plans.marts import EXPERIENCE_BANDS, WAIT_BANDS


def one(spark, column, schema="a string, b string", row=(None, None)):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("age", "label"),
    [(0, "0-12"), (12, "0-12"), (13, "13-17"), (17, "13-17"), (18, "18-40"), (40, "18-40"), (41, "41-65"),
     (65, "41-65"), (66, "+65"), (-1, "Desconocido"), (None, "Desconocido")],
)
def test_age_bands(spark, age, label):
    banded = fn.band("a", AGE_BANDS, "+65", floor=0, unknown="Desconocido")
    assert one(spark, banded, "a bigint", (age,)) == label


@pytest.mark.parametrize(
    ("wait", "label"),
    [(0.0, "Optimo"), (20.0, "Optimo"), (20.1, "Aceptable"), (45.0, "Aceptable"), (120.0, "Alto"), (120.1, "Critico"),
     (None, "Critico")],
)
def test_wait_bands(spark, wait, label):
    assert one(spark, fn.band("a", WAIT_BANDS, "Critico"), "a double", (wait,)) == label


@pytest.mark.parametrize(
    ("years", "label"), [(1.9, "Junior"), (2.0, "Semior"), (5.0, "Senior"), (10.0, "Experto"), (None, "Experto")]
)
def test_experience(spark, years, label):
    assert one(spark, fn.band("a", EXPERIENCE_BANDS, "Experto", side="<"), "a double", (years,)) == label


def test_ages_and_tenure(spark):
    as_of = date(2024, 1, 1)
    assert one(spark, fn.age_years("a", as_of), row=("2000-01-02", None)) == 23
    assert one(spark, fn.age_years("a", as_of), row=("1999-12-31", None)) == 24
    assert one(spark, fn.age_years("a", as_of), row=("no date", None)) is None
    assert one(spark, fn.tenure_years("a", as_of), row=("2022-07-01", None)) == 1.5
    assert one(spark, fn.tenure_years("a", as_of)) is None
    assert one(spark, fn.tenure_years("a", as_of, if_null=0.0)) == 0.0


@pytest.mark.parametrize(
    ("start", "end", "minutes"),
    [("2024-01-01 08:00:00", "2024-01-01 08:20:30", 20.5), ("2024-01-01 23:50:00", "2024-01-02 00:10:00", 20.0),
     ("2024-01-01 09:00:00", "2024-01-01 08:00:00", -60.0), ("2024-01-01 09:00:00", None, None),
     ("broken", "2024-01-01 08:00:00", None)],
)
def test_elapsed(spark, start, end, minutes):
    assert one(spark, fn.elapsed("a", "b"), row=(start, end)) == minutes


@pytest.mark.parametrize(
    ("day", "time", "flag"),
    [("2024-01-07", "10:00:00", 0), ("2024-01-08", "06:59:00", 0), ("2024-01-08", "07:00:00", 1),
     ("2024-01-12", "17:59:00", 1), ("2024-01-12", "18:00:00", 0), (None, "10:00:00", 0), ("2024-01-08", None, 0)],
)
def test_business_hours(spark, day, time, flag):
    assert one(spark, fn.business_hours_flag("a", "b"), row=(day, time)) == flag


@pytest.mark.parametrize(
    ("unit", "rate", "status"),
    [("UCI", 0.85, "Critico"), ("UCI", 0.8499, "Precaucion"), ("Urgencias", 0.88, "Precaucion"),
     ("Urgencias", 0.90, "Critico"), ("General", 0.88, "Critico"), ("General", 0.70, "Precaucion"),
     ("General", 0.6999, "Normal"), ("Pasillo", 0.99, "Precaucion"), ("UCI", None, "Normal"), (None, 0.95, "Precaucion")],
)
def test_threshold_status(spark, unit, rate, status):
    column = fn.threshold_status("r", "u", CRITICAL_OCCUPANCY, CAUTION_OCCUPANCY)
    assert one(spark, column, "u string, r double", (unit, rate)) == status


@pytest.mark.parametrize(("used", "free", "rate"), [(0, 0, 0.0), (1, 2, 0.3333), (5, -5, 0.0), (None, 3, 0.0)])
def test_share_of_sum(spark, used, free, rate):
    assert one(spark, fn.share_of_sum("a", "b"), "a bigint, b bigint", (used, free)) == rate


def test_pct_and_totals(spark):
    assert one(spark, fn.pct("a", "b"), "a bigint, b bigint", (1, 3)) == 33.33
    assert one(spark, fn.pct("a", "b"), "a bigint, b bigint", (1, 0)) == 0.0
    assert one(spark, fn.total("a", "b"), "a bigint, b bigint", (1, None)) is None
    assert one(spark, fn.line_total("a", "b"), "a bigint, b double", (3, 1.115)) == pytest.approx(3.35, abs=0.011)
    assert one(spark, fn.line_total("a", "b"), "a bigint, b double", (3, None)) is None


@pytest.mark.parametrize(
    ("specialty", "code", "flag"),
    [("Cardiologia", "I10", 0), ("Cardiologia", "C50", 1), ("Pediatria", "C50", 0), (None, "C50", 0),
     ("Cardiologia", None, 0)],
)
def test_rule_matrix(spark, specialty, code, flag):
    assert one(spark, fn.rule_matrix_flag("a", "b", EXPECTED_DIAGNOSES), row=(specialty, code)) == flag


@pytest.mark.parametrize(
    ("value", "result"),
    [("Planta", "Planta"), ("planta", "Otro"), ("Planta ", "Otro"), ("", "Otro"), (None, "Otro")],
)
def test_standardize(spark, value, result):
    assert one(spark, fn.standardize("a", ["Planta"], "Otro"), row=(value, None)) == result


def test_standardize_null_default_and_mapping(spark):
    column = fn.standardize("a", ["X"], "Otra", "No Informado")
    assert one(spark, column) == "No Informado"
    assert one(spark, fn.standardize("a", mapping={"Peru": "PER"}, default="OTR"), row=("Peru", None)) == "PER"


def test_text(spark):
    assert one(spark, fn.normalize_text("a"), row=("  costa RICA ", None)) == "Costa Rica"
    assert one(spark, fn.sha256_hex("a"), row=("", None)) is None
    assert one(spark, fn.sha256_hex("a")) is None
    import hashlib

    assert one(spark, fn.sha256_hex("a"), row=("ñandú", None)) == hashlib.sha256("ñandú".encode()).hexdigest()


def test_calendar(spark):
    year, week = fn.iso_week_parts("a")
    assert one(spark, F.struct(year, week), row=("2024-12-30", None))[:] == (2025, 1)
    year, week = fn.iso_week_parts("a", calendar_year=True)
    assert one(spark, F.struct(year, week), row=("2024-12-30", None))[:] == (2024, 1)
    assert one(spark, fn.date_parts("a")["_hora"], row=("2024-12-30 17:05:00", None)) == 17
    assert one(spark, fn.date_parts("a")["_dia"], row=("never", None)) is None
