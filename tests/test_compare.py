"""Comparison by digests against a plain comparison, and of published loads."""

import random

import pytest
from helpers import rows_of
from pyspark.sql.types import StructType

from clientlens.operators import compare

SCHEMA = "k string, a int, b string, part string"


def plain(old, new):
    found = []
    for key in {*old, *new} - {None}:
        if old.get(key) != new.get(key):
            change = "ADDED" if key not in old else "REMOVED" if key not in new else "CHANGED"
            found.append((key, change, *old.get(key, (None, None)), *new.get(key, (None, None))))
    return sorted(found, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(k, *v, "x") for k, v in rows.items()], SCHEMA)


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_changes(spark, buckets):
    rng = random.Random(3)
    value = lambda: (rng.choice([None, 1, 2]), rng.choice([None, "", "x"]))
    old = {f"k{i}": value() for i in range(300)} | {None: (1, "x")}
    new = {k: v if rng.random() < 0.9 else value() for k, v in old.items() if rng.random() < 0.95}
    new |= {f"n{i}": value() for i in range(9)} | {None: (2, "y")}
    old["swap"], new["swap"] = (None, "x"), (1, None)
    found = compare.changes(frame(spark, old), frame(spark, new), "k", ["a", "b"], buckets)
    assert rows_of(found) == plain(old, new)


def test_values_that_change_places(spark):
    old, new = {"p": (1, "x"), "q": (2, "y")}, {"p": (2, "y"), "q": (1, "x")}
    assert rows_of(compare.changes(frame(spark, old), frame(spark, new), "k", ["a", "b"], 1)) == plain(old, new)


def test_equal_versions_end_without_a_join(spark):
    rows = {f"k{i}": (i, None) for i in range(50)}
    found = compare.changes(frame(spark, rows), frame(spark, dict(reversed(rows.items()))).repartition(5), "k", ["a", "b"])
    plan = found._jdf.queryExecution().toString()
    assert "Join" not in plan and found.count() == 0
    other = compare.changes(frame(spark, rows), frame(spark, rows | {"n": (1, "x")}), "k", ["a", "b"])
    assert found.schema.simpleString() == other.schema.simpleString()
    assert compare.changes(frame(spark, rows).limit(0), frame(spark, rows).limit(0), "k", ["a", "b"]).count() == 0


def test_only_differing_buckets_are_joined(spark):
    old = {f"k{i}": (i, "x") for i in range(500)}
    new = old | {"k7": (7, "y")}
    buckets = compare.differing_buckets(frame(spark, old), frame(spark, new), "k", ["a", "b"], 100)
    assert len(buckets) == 1
    assert rows_of(compare.changes(frame(spark, old), frame(spark, new), "k", ["a", "b"], 100)) == plain(old, new)


def test_published_loads_read_only_what_differs(spark, lake):
    table = lake.table("silver", "t", StructType.fromDDL(SCHEMA), "part")
    rows = [(f"k{i}", i, "x", f"p{i % 3}") for i in range(30)]
    table.replace(spark.createDataFrame(rows, SCHEMA))
    table.overwrite_partitions(spark.createDataFrame([("k0", 0, "new", "p0"), ("k3", 3, "x", "p0")], SCHEMA))
    old, new = table.difference(1, 2)
    assert (old.count(), new.count()) == (10, 2)
    found = rows_of(compare.changes(old, new, "k", ["a", "b"]).select("k", "change"))
    assert found == sorted([("k0", "CHANGED"), *((f"k{i}", "REMOVED") for i in range(6, 30, 3))])
    # A compact copy holds the same rows in other files.
    folder, _ = table.draft(table.read())
    table.publish(folder)
    assert compare.changes(*table.difference(2, 3), "k", ["a", "b"]).isEmpty()
    assert compare.changes(*table.difference(3, 3), "k", ["a", "b"]).isEmpty()
