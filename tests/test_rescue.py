import os
from datetime import datetime

import pytest

from tidemark.sources import rescue
from tidemark.sources.files import conform_schema
from tidemark.sources.tables import LakeTable
from tidemark.spec import TableSpec, columns
from tidemark.streaming.ingest import load_to_table

SCHEMA = columns("k long!, day date, n integer, price double, ok boolean, note string")
MONEY = {"price": (6, 2)}


def landed(tmp_path, lines, name="a.csv"):
    os.makedirs(f"{tmp_path}/in", exist_ok=True)
    with open(f"{tmp_path}/in/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")
    return f"{tmp_path}/in"


def listed(df, **options):
    return sorted([tuple(r) for r in rescue.rejected_values(df, ["k"], **options).collect()], key=repr)


CSV = [
    "k,day,n,price,ok,note", "1,2024-01-31,5,1.005,true,x", "2,2024-02-30,5.5,12345,maybe,", "x3,,,,,", "4,2024-01-01",
    "5,2024-01-01,1,1,true,a,b", '6,2024-01-01,99999999999,"1,5",false,"q \\"z\\", y"', "7, ,1,1e2,true,x",
]
JSON = [
    '{"k":1,"day":"2024-01-31","n":5,"price":1.005,"ok":true,"note":"x"}', '{"k":"2","n":"5.5","price":{"a":1},"note":7}', "not json",
    '{"k":[3]}', '{"k":4,"n":', "", '{"k":5,"other":1,"n":null}',
]


def test_csv(spark, tmp_path):
    rows = rescue.conform_rescued(rescue.read_landing(spark, landed(tmp_path, CSV), "csv", SCHEMA), SCHEMA, MONEY)
    bad, cut = "VALOR_ILEGIBLE: ", "REGISTRO_ILEGIBLE"
    assert listed(rows) == sorted([
        (2, "day", "2024-02-30", "date", bad + "day"), (2, "n", "5.5", "int", bad + "n"), (2, "price", "12345", "decimal(6,2)", bad + "price"),
        (2, "ok", "maybe", "boolean", bad + "ok"), (None, "k", "x3", "bigint", bad + "k"), (None, None, CSV[4], None, cut),
        (None, None, CSV[5], None, cut), (6, "n", "99999999999", "int", bad + "n"), (6, "price", "1,5", "decimal(6,2)", bad + "price"),
        (7, "day", " ", "date", bad + "day"),
    ], key=repr)
    kept = {r.k: r for r in rescue.readable_rows(rows).collect()}
    assert set(kept) == {1, 2, 6, 7, None} and str(kept[1].price) in ("1.01", "1.00") and kept[6].note == 'q "z", y' and kept[2].note is None


def test_json(spark, tmp_path):
    rows = rescue.conform_rescued(rescue.read_landing(spark, landed(tmp_path, JSON, "a.json"), "json", SCHEMA), SCHEMA, MONEY)
    bad, cut = "VALOR_ILEGIBLE: ", "REGISTRO_ILEGIBLE"
    assert listed(rows) == sorted([
        (2, "n", "5.5", "int", bad + "n"), (2, "price", '{"a":1}', "decimal(6,2)", bad + "price"), (None, None, "not json", None, cut),
        (None, "k", "[3]", "bigint", bad + "k"), (None, None, '{"k":4,"n":', None, cut),
    ], key=repr)
    kept = {r.k: r for r in rescue.readable_rows(rows).collect()}
    assert set(kept) == {1, 2, 5, None} and kept[2].note == "7" and kept[5].n is None


def test_a_record_is_judged_whole_whatever_is_selected(spark, tmp_path):
    rows = rescue.conform_rescued(rescue.read_landing(spark, landed(tmp_path, CSV), "csv", SCHEMA), SCHEMA, MONEY)
    assert rescue.rejected_values(rows).filter("columna IS NULL").count() == 2
    assert rescue.readable_rows(rows).select("k").count() == 5
    assert {r[0] for r in rows.filter(rows[rescue.RECORD].isNotNull()).select(rescue.RECORD).collect()} == {CSV[4], CSV[5]}


def test_hidden_values_stay_hidden(spark, tmp_path):
    rows = rescue.conform_rescued(rescue.read_landing(spark, landed(tmp_path, CSV), "csv", SCHEMA), SCHEMA, MONEY)
    shown = listed(rows, hidden=["price"])
    assert len(shown) == 10 and [r for r in shown if r[1] in ("price", None) and r[2] is not None] == []
    assert (2, "n", "5.5", "int", "VALOR_ILEGIBLE: n") in shown


def test_what_is_typed_already(spark):
    rows = spark.createDataFrame([(1, 123456.0), (2, 1.5)], "k long, price double")
    out = rescue.conform_rescued(rows, SCHEMA, MONEY)
    assert listed(out) == [(1, "price", "123456.0", "decimal(6,2)", "VALOR_ILEGIBLE: price")]
    assert rescue.conform_rescued(rows.select("k"), SCHEMA).columns == ["k", rescue.REJECTED]
    with pytest.raises(ValueError):
        rescue.read_landing(spark, "/nowhere", "parquet", SCHEMA)


def test_stream_keeps_errors_once_and_takes_up_where_it_was(spark, tmp_path):
    spec = TableSpec("t", SCHEMA, ["k"], "day", fmt="csv", decimals=MONEY, watermark="seen")
    table, errors = LakeTable(spark, f"{tmp_path}/table"), f"{tmp_path}/errors"

    def load():
        load_to_table(spark, spec, f"{tmp_path}/in", table, f"{tmp_path}/check", now=lambda: datetime(2024, 1, 1), errors=errors)
        return table.read().count(), spark.read.parquet(errors).count() if os.path.isdir(errors) else 0

    landed(tmp_path, ["k,day,n,price,ok,note", "1,2024-01-31,5,1,true,x"], "1.csv")
    assert load() == (1, 0)
    landed(tmp_path, CSV, "2.csv")
    assert load() == (6, 10)
    assert load() == (6, 10)
    landed(tmp_path, ["k,day,n,price,ok,note", "9,2024-01-31,z,1,true,x"], "3.csv")
    assert load() == (7, 11)
    row = spark.read.parquet(errors).filter("payload LIKE '%\"z\"%'").first()
    assert (row.tabla_origen, row.motivo_error, row.payload) == ("t", "VALOR_ILEGIBLE: n", '{"k":9,"columna":"n","texto":"z","tipo":"int"}')


def test_a_batch_whose_errors_were_not_written_says_them_again(spark, tmp_path, monkeypatch):
    """The stream dies between the batch and its errors; the replay doesn't append again, and writes them."""
    from tidemark.streaming import ingest

    spec = TableSpec("t", SCHEMA, ["k"], "day", fmt="csv", decimals=MONEY, watermark="seen")
    table, errors = LakeTable(spark, f"{tmp_path}/table"), f"{tmp_path}/errors"
    landed(tmp_path, CSV)
    real = ingest.quarantine

    def load():
        load_to_table(spark, spec, f"{tmp_path}/in", table, f"{tmp_path}/check", now=lambda: datetime(2024, 1, 1), errors=errors)

    def dies(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "quarantine", dies)
    with pytest.raises(Exception, match="lost"):
        load()
    assert table.read().count() == 5 and not os.path.isdir(errors)
    monkeypatch.setattr(ingest, "quarantine", real)
    load()
    assert table.read().count() == 5 and spark.read.parquet(errors).count() == 10


def test_values_with_too_many_digits_throw_no_error_for_each_row(spark):
    """A double is only cast to a decimal that has room for it; before, each failed cast threw and caught an error."""
    texts = ["9999.99", "9999.994", "9999.995", "10000", "-9999.99", "-10000", "NaN", "Infinity", "1e300", "x", None]
    out = conform_schema(spark.createDataFrame([(t,) for t in texts], "v string"), columns("v double"), {"v": (6, 2)})
    assert [None if r.v is None else str(r.v) for r in out.collect()] == ["9999.99", "9999.99", None, None, "-9999.99", *[None] * 6]
    assert "CASE WHEN" in out._jdf.queryExecution().executedPlan().toString()


def test_collecting_rejected_values_stays_in_generated_code(spark):
    rows = rescue.conform_rescued(spark.createDataFrame([("1", "x")], "a string, b string"), columns("a integer, b integer"))
    assert rows.first()[rescue.REJECTED] == [("b", "x", "int")]
    assert "lambda" not in rows._jdf.queryExecution().executedPlan().toString()
