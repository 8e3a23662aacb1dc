import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.distinct import distinct_bitmaps, distinct_counts, merged_bitmaps


def test_counts_at_any_grain_and_after_any_merge(spark):
    rng = random.Random(4)
    ids = [None, 0, 1, -1, -32768, 32768, 32769, 2**40, -(2**40), *range(50)]
    rows = [(rng.choice(["a", "b", None]), rng.randrange(4), rng.choice(ids)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, m int, id bigint")
    loads = [distinct_bitmaps(df.filter(F.col("m") % 2 == k), ["g", "m"], "id") for k in (0, 1)]
    held = merged_bitmaps(loads[0].unionByName(loads[1]).unionByName(loads[0]), ["g", "m"])
    for keys in (["g", "m"], ["g"], ["m"], []):
        want = df.groupBy(*keys).agg(F.countDistinct("id").alias("n"))
        assert sorted(map(str, distinct_counts(held, keys, "n").collect())) == sorted(map(str, want.collect()))


def test_only_whole_numbers(spark):
    with pytest.raises(ValueError, match="string"):
        distinct_bitmaps(spark.createDataFrame([("a",)], "id string"), [], "id")
    none = distinct_bitmaps(spark.createDataFrame([("a", None)], "g string, id int"), ["g"], "id")
    assert distinct_counts(none, ["g"], "n").isEmpty()
