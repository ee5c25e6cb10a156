from datetime import datetime

from helpers import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clientlens.operators import cleansing
from clientlens.schemas import BRONZE, align_to_schema, dropped_columns


def test_strings_are_trimmed_of_spaces_only(spark):
    df = spark.createDataFrame([("  a ", 1), ("   ", 2), ("\tb", 3), (None, 4)], "s string, n int")
    assert rows_of(cleansing.clean_strings(df), "n") == [("a", 1), (None, 2), ("\tb", 3), (None, 4)]


def test_only_present_columns_are_upper_cased(spark):
    df = spark.createDataFrame([("x", "y")], "status string, city string")
    got = cleansing.upper_columns(df, ["status", "currency"])
    assert rows_of(got) == [("X", "y")] and got.columns == ["status", "city"]


def test_null_keys_are_dropped(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("c", "d")], "k string, l string")
    assert rows_of(cleansing.drop_null_keys(df, ["k", "l"])) == [("c", "d")]


def test_ties_are_broken_by_all_columns(spark):
    stamp = datetime(2024, 1, 1)
    rows = [("k", 1, None, stamp), ("k", 2, "a", stamp), ("k", 2, "b", stamp), ("k", 9, "z", None)]
    df = spark.createDataFrame(rows, "id string, n int, s string, at timestamp")
    assert rows_of(cleansing.latest_per_key(df, ["id"], ["at"])) == [("k", 2, "b", stamp)]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)),
        min_size=1,
        max_size=40,
    )
)
def test_latest_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, at int, v int").repartition(3)
    best = {}
    for k, at, v in rows:
        rank = (at is not None, at or 0, v)
        best[k] = max(best.get(k, rank), rank)
    expected = sorted((k, r[1] if r[0] else None, r[2]) for k, r in best.items())
    assert rows_of(cleansing.latest_per_key(df, ["k"], ["at"]), "k") == expected


def test_one_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id DIV 900 AS k", "id AS v")
    plan = cleansing.latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[:exchange] and "WindowGroupLimit" in plan[exchange:]


def test_alignment_casts_fills_and_drops(spark):
    schema = BRONZE["oracle_products"]
    df = spark.createDataFrame(
        [("P1", "12.5", "x"), ("P2", "n/a", "x")], "PRODUCT_ID string, Interest_Rate string, extra string"
    )
    aligned = align_to_schema(df, schema)
    assert aligned.columns == schema.names
    assert rows_of(aligned.select("product_id", "interest_rate", "status")) == [
        ("P1", 12.5, None),
        ("P2", None, None),
    ]
    assert dropped_columns(df, schema) == ["extra"]


def test_columns_without_an_order_are_refused(spark):
    import pytest

    frame = spark.sql("SELECT 1 AS k, map('a', 1) AS m")
    with pytest.raises(ValueError, match="ordered by m"):
        cleansing.latest_per_key(frame, ["k"], [])
