import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clientlens.operators.ranking import bucket_ends, with_buckets


def _both(spark, rows, buckets=5):
    df = spark.createDataFrame(rows, "id string, a int, b double").repartition(6)
    got = with_buckets(df, "id", {"ta": -F.col("a"), "tb": F.col("b")}, buckets)
    by_a = Window.orderBy(F.desc("a"), "id")
    by_b = Window.orderBy("b", "id")
    want = df.withColumn("ta", F.ntile(buckets).over(by_a)).withColumn(
        "tb", F.ntile(buckets).over(by_b)
    )
    key = lambda r: r["id"]
    return sorted(got.collect(), key=key), sorted(want.collect(), key=key)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 7, 203])
def test_matches_ntile(spark, n):
    rng = random.Random(n)
    rows = [(f"c{i:04d}", rng.randrange(6), float(rng.randrange(4))) for i in range(n)]
    got, want = _both(spark, rows)
    assert got == want


def test_all_equal_keys_are_split_by_id(spark):
    got, want = _both(spark, [(f"c{i:04d}", 1, 0.0) for i in range(101)])
    assert got == want
    sizes = [sum(r["ta"] == b for r in got) for b in range(1, 6)]
    assert sizes == [21, 20, 20, 20, 20]


@pytest.mark.parametrize("n", range(0, 40))
def test_bucket_ends(n):
    ends = bucket_ends(n, 5)
    sizes = [b - a for a, b in zip([0, *ends], [*ends, n])]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert sizes == sorted(sizes, reverse=True)


def test_buckets_are_assigned_without_a_window_or_shuffle(spark):
    df = spark.range(50).selectExpr("CAST(id AS STRING) AS id", "id % 7 AS a")
    plan = with_buckets(df, "id", {"t": F.col("a")}, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
