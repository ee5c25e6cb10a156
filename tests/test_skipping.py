"""What loads and lookups leave unread and unwritten."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructType

from clientlens.jobs import conform, gold
from clientlens.plans.lists import customer_lookup
from clientlens.schemas import GOLD, align_to_schema
from clientlens.sources.lake import live_parts

SCHEMA = StructType().add("id", StringType()).add("v", IntegerType())
FACTS = StructType().add("id", StringType()).add("day", DateType())


def rows_read(frame):
    """Rows that the scans of a query gave, by Spark's own count."""
    frame = frame.select(*frame.columns)
    frame.collect()
    todo, total = [frame._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(plan.plan())
        if name == "FileSourceScanExec":
            total += plan.metrics().apply("numOutputRows").value()
        children = plan.children()
        todo += [children.apply(i) for i in range(children.length())]
    return total


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


def test_only_hit_buckets_are_written(spark, lake):
    table = lake.table("silver", "t", SCHEMA, "id", buckets=8, lookup="id")
    table.replace(spark.range(1000).selectExpr("concat('k', id) AS id", "1 AS v"))
    before = files_of(f"{table.path}/data")
    delivery = spark.createDataFrame([("k5", 2)], SCHEMA)
    touched = table.touched(delivery)
    n = touched.count()
    assert 0 < n < 300 and touched.filter("id = 'k5'").count() == 1
    assert table.overwrite_partitions(conform.scd.scd1_merge(touched, delivery, "id")) == n
    assert {f: t for f, t in files_of(f"{table.path}/data").items() if f in before} == before
    live = live_parts(table.entries())[0]
    assert len(live) == 8 and len({folder for folder, _ in live}) == 2
    assert (table.read().count(), [tuple(r) for r in table.read().filter("v = 2").collect()]) == (1000, [("k5", 2)])


def test_another_number_of_buckets(spark, lake):
    lake.table("silver", "t", SCHEMA).replace(spark.createDataFrame([("a", 1)], SCHEMA))
    keys = spark.createDataFrame([("a", 2)], SCHEMA)
    assert lake.table("silver", "t", SCHEMA, "id", buckets=4).touched(keys) is None
    table = lake.table("silver", "t", SCHEMA, "id", buckets=4)
    table.replace(keys)
    assert table.touched(keys).count() == 1 and lake.table("silver", "t", SCHEMA, "id", buckets=40).touched(keys) is None
    assert table.touched(keys.limit(0)).count() == 0


def test_keys_without_value_have_a_bucket(spark, lake):
    table = lake.table("silver", "t", SCHEMA, "id", buckets=4, lookup="id")
    table.replace(spark.createDataFrame([(None, 1), ("", 2)], SCHEMA))
    assert sorted(r.v for r in table.read().collect()) == [1, 2]


@pytest.fixture
def facts(spark, lake):
    """Ids that grow with the day, as transaction numbers do."""
    table = lake.table("silver", "f", FACTS, "day", True)
    table.replace(spark.range(3000).selectExpr("format_string('T%08d', id) AS id", "date_add(DATE '2024-01-01', CAST(id / 10 AS INT)) AS day"))
    return table


def near(facts, keys):
    spark = facts.spark
    ranges = conform.zones(spark.createDataFrame([(k,) for k in keys], "id string"), "id")
    hit = F.lit(False)
    for low, high in ranges:
        hit |= F.col("id").between(low, high)
    return facts.read().filter(hit)


def test_new_ids_read_no_stored_row(facts):
    assert rows_read(near(facts, ["T00009000", "T00009001"])) == 0
    late = near(facts, ["T00000007", "T00009001"])
    assert "T00000007" in {r.id for r in late.collect()}
    assert conform.zones(facts.read().limit(0), "id") == []


def test_zones_hold_every_key(spark):
    keys = [f"k{i:04d}" for i in range(700)] + [None, "k0001"]
    ranges = conform.zones(spark.createDataFrame([(k,) for k in keys], "id string"), "id")
    assert len(ranges) <= conform.ZONES and all(any(a <= k <= b for a, b in ranges) for k in keys if k)


@pytest.mark.parametrize("n", [4000, 40000])
def test_a_lookup_skips_row_groups(spark, lake, n):
    table = gold.gold_table(lake, "mart_customer_360")
    rows = spark.range(n).selectExpr("sha2(CAST(id AS STRING), 256) AS customer_id", "DATE '2024-01-31' AS snapshot_date")
    spark.conf.set("parquet.block.size", "65536")
    try:
        table.replace(align_to_schema(rows, GOLD["mart_customer_360"]))
    finally:
        spark.conf.unset("parquet.block.size")
    wanted = rows.first().customer_id
    found = customer_lookup(table.read(), wanted).select("customer_id", "snapshot_date")
    assert found.count() == 1
    # As many as row groups hold, whatever the size of the table.
    assert 0 < rows_read(found) <= 2500
    assert rows_read(customer_lookup(table.read(), "nobody").select("customer_id")) <= 2500
