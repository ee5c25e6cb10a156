from datetime import datetime, timedelta

import pytest
from helpers import moment, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clientlens.config import SilverTable
from clientlens.operators import scd

TABLE = SilverTable("dim_x", "scd2", "x", "id", ("seg", "city"), ("name",), "x_sk")
SCHEMA = "id string, name string, seg string, city string"
HISTORY = (
    "x_sk string, id string, name string, seg string, city string, row_hash string, "
    "effective_from timestamp, effective_to timestamp, is_current boolean, version int, "
    "_silver_loaded_at timestamp, _silver_batch_id string"
)
T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3))


def _apply(spark, deliveries, **options):
    state = spark.createDataFrame([], HISTORY)
    for i, rows in enumerate(deliveries):
        incoming = spark.createDataFrame(rows, SCHEMA)
        run = T1 + timedelta(days=i)
        state = scd.scd2_apply(state, incoming, TABLE, run, f"b{i}", **options)
    return state


def test_versions_open_and_close(spark):
    state = _apply(
        spark,
        [
            [("a", "A", "x", None), ("b", "B", "x", "h"), ("c", "C", "x", "h")],
            [("a", "A", "y", None), ("b", "B2", "x", "h"), ("d", "D", "x", "h")],
            [("a", "A", "z", None)],
        ],
    )
    got = rows_of(
        state.select("id", "version", "seg", "name", "is_current", "effective_from", "effective_to"),
        "id",
        "version",
    )
    assert got == [
        ("a", 1, "x", "A", False, T1, T2),
        ("a", 2, "y", "A", False, T2, T3),
        ("a", 3, "z", "A", True, T3, None),
        ("b", 1, "x", "B", True, T1, None),
        ("c", 1, "x", "C", True, T1, None),
        ("d", 1, "x", "D", True, T2, None),
    ]


def test_attributes_can_be_refreshed_in_place(spark):
    state = _apply(spark, [[("b", "B", "x", "h")], [("b", "B2", "x", "h")]], refresh_attributes=True)
    assert rows_of(state.select("id", "name", "version")) == [("b", "B2", 1)]


def test_moved_separator_is_a_change(spark):
    """Both rows have the same digest text 'a|b|c'."""
    state = _apply(spark, [[("k", "n", "a|b", "c")], [("k", "n", "a", "b|c")]])
    assert state.select("row_hash").distinct().count() == 1
    assert rows_of(state.select("version", "is_current")) == [(1, False), (2, True)]


def test_run_time_must_advance(spark):
    state = _apply(spark, [[("a", "A", "x", "h")]])
    scd.check_advances(state, T2)
    with pytest.raises(ValueError, match="not after"):
        scd.check_advances(state, T1)


_delivery = st.dictionaries(
    st.sampled_from("abc"), st.sampled_from(["x", "y", None]), min_size=1, max_size=3
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_delivery, min_size=1, max_size=3))
def test_history_is_consistent(spark, deliveries):
    rows = [[(k, "n", v, "h") for k, v in d.items()] for d in deliveries]
    state = _apply(spark, [r for d in rows for r in (d, d)])  # every delivery arrives twice
    last = {}
    for d in deliveries:
        last.update(d)
    current = {r["id"]: r["seg"] for r in state.filter("is_current").collect()}
    assert current == last
    by_key = {}
    for r in state.orderBy("id", "version").collect():
        by_key.setdefault(r["id"], []).append(r)
    for versions in by_key.values():
        assert [v["version"] for v in versions] == list(range(1, len(versions) + 1))
        assert [v["is_current"] for v in versions] == [False] * (len(versions) - 1) + [True]
        for older, newer in zip(versions, versions[1:]):
            assert older["effective_to"] == newer["effective_from"]
            assert older["seg"] != newer["seg"]


def test_changes_report_kind_and_old_version(spark):
    state = _apply(spark, [[("a", "A", "x", "h"), ("b", "B", "x", "h")]])
    incoming = spark.createDataFrame(
        [("a", "A", None, "h"), ("b", "Z", "x", "h"), ("c", "C", "x", "h")], SCHEMA
    )
    got = scd.scd2_changes(state, incoming, TABLE).select("id", "change", "old_version")
    assert rows_of(got) == [("a", "CHANGED", 1), ("c", "NEW", None)]


def test_as_of_bounds(spark):
    state = _apply(spark, [[("a", "A", "x", "h")], [("a", "A", "y", "h")]])
    for at, expected in [(T1 - timedelta(seconds=1), []), (T1, ["x"]), (T2, ["y"]), (T3, ["y"])]:
        assert [r["seg"] for r in scd.scd2_as_of(state, at).collect()] == expected
    facts = spark.createDataFrame(
        [("f1", "a", T1), ("f2", "a", T2), ("f3", "q", T2)], "f string, id string, at timestamp"
    )
    joined = scd.join_as_of(facts, state, "id", "at", ["seg"]).select("f", "seg")
    assert rows_of(joined) == [("f1", "x"), ("f2", "y"), ("f3", None)]


def test_type_one_merge(spark):
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    incoming = spark.createDataFrame([("b", 9), ("c", 3)], "id string, v int")
    once = scd.scd1_merge(stored, incoming, "id")
    assert rows_of(once) == [("a", 1), ("b", 9), ("c", 3)]
    assert rows_of(scd.scd1_merge(once, incoming, "id")) == rows_of(once)


def test_known_facts_are_not_added_again(spark):
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    incoming = spark.createDataFrame([("b", 9), ("c", 3)], "id string, v int")
    assert rows_of(scd.fact_new_rows(stored, incoming, "id")) == [("c", 3)]


def test_surrogate_key_digest(spark):
    import hashlib

    df = spark.createDataFrame([("CIF1",)], "id string")
    got = df.select(scd.surrogate_key("id", moment("2024-05-06T07:08:09.5"))).first()[0]
    assert got == hashlib.md5(b"CIF1|2024-05-06 07:08:09").hexdigest()


def test_history_of_one_key(spark):
    state = _apply(spark, [[("a", "A", "x", "h")], [("a", "A", "y", "h")]])
    assert [r["version"] for r in scd.scd2_history(state, "id", "a").collect()] == [1, 2]
    assert state.filter(F.col("row_hash").isNull()).count() == 0
