"""The stream with a watermark: late rows, rows without a time, copies, replays, nothing at all."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import read_or_empty, stream_files
from tidemark.streaming.late import LATE, MARKS, UNDATED, _split, load_on_time, on_time, too_late

FORM = T.StructType([T.StructField("k", T.LongType()), T.StructField("at", T.TimestampType()), T.StructField("v", T.StringType())])


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def load(spark, tmp_path, rows):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "late")
    if rows:
        spark.createDataFrame(rows, FORM).coalesce(1).write.mode("append").parquet(landing)
    load_on_time(stream_files(spark, landing, "parquet", FORM), ["k"], "at", "2 days", root)
    taken = sorted((r.k, r.v) for r in on_time(spark, FORM, root).collect())
    late = sorted((r.k, r.v, r.motivo_error) for r in too_late(spark, FORM, root).collect())
    return taken, late


def test_three_loads(spark, tmp_path):
    first = [(1, at(5), "a"), (1, at(5), "a"), (2, at(9), "b"), (3, None, "c")]
    # The first batch has no mark yet: nothing of it is late, however old.
    assert load(spark, tmp_path, first) == ([(1, "a"), (2, "b")], [(3, "c", UNDATED)])
    # The mark is 7 January. A row on it is on time; a copy of what was taken is dropped, one that is too late is reported.
    second = [(4, at(7), "d"), (5, at(6, 23), "e"), (2, at(9), "b"), (1, at(5), "a"), (6, at(20), "f")]
    late = [(1, "a", LATE), (3, "c", UNDATED), (5, "e", LATE)]
    assert load(spark, tmp_path, second) == ([(1, "a"), (2, "b"), (4, "d"), (6, "f")], late)
    assert load(spark, tmp_path, [(7, at(17), "g")]) == ([(1, "a"), (2, "b"), (4, "d"), (6, "f")], sorted([*late, (7, "g", LATE)]))


def test_a_load_of_undated_rows_sets_no_mark(spark, tmp_path):
    assert load(spark, tmp_path, [(1, None, "a")]) == ([], [(1, "a", UNDATED)])
    assert load(spark, tmp_path, [(2, at(1), "b")]) == ([(2, "b")], [(1, "a", UNDATED)])


def test_nothing_has_landed(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    assert load(spark, tmp_path, []) == ([], [])


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "late")
    batch = spark.createDataFrame([(1, at(5), "a"), (2, None, "b")], FORM)
    for _ in range(2):
        _split(batch, 0, "at", "2 days", root)
    assert too_late(spark, FORM, root).count() == 1 and read_or_empty(spark, f"{root}/marks", MARKS).count() == 1
    # Its own mark is no reason to call a batch late.
    _split(batch.withColumn("at", F.lit(at(1))), 0, "at", "2 days", root)
    assert too_late(spark, FORM, root).count() == 0
