"""Export of the mart and its trends for reporting tools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.plans.mart import MART_COLUMNS
from clientlens.plans.trends import active_customers, daily_trend
from clientlens.sources.scratch import materialise

EXPORT_COLUMNS = [c for c in MART_COLUMNS if c not in ("phone_masked", "email_masked")]


def export_metadata(mart: DataFrame, trend: DataFrame) -> DataFrame:
    """One row that describes an export: snapshots, months, day range, rows and columns.

    Rows are counted per snapshot and per day first, so the lists are built from one entry per
    snapshot and per month.
    """
    per_snapshot = mart.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))
    of_mart = per_snapshot.agg(
        F.max("snapshot_date").alias("snapshot_date"),
        F.array_sort(F.collect_set(F.date_format("snapshot_date", "yyyy-MM-dd"))).alias("snapshots"),
        F.max_by("n", "snapshot_date").alias("row_count"),
        F.array(*[F.lit(c) for c in mart.columns]).alias("columns"),
    )
    per_month = trend.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.min("day").alias("first"), F.max("day").alias("last")
    )
    of_trend = per_month.agg(
        F.array_sort(F.collect_set("month")).alias("months"),
        F.min("first").alias("first_day"),
        F.max("last").alias("last_day"),
    )
    parts = of_mart.unionByName(of_trend, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def export_reports(mart: DataFrame, days: DataFrame, folder: str) -> DataFrame:
    """Write mart, trend and active-customer tables as compressed Parquet, with metadata.

    ``days`` is the customer-day frame of the trends. Returns the metadata row.
    """
    chosen = mart.select(*EXPORT_COLUMNS)
    shared = materialise(days, "customer-days")
    tables = {
        "mart_customer_360": chosen,
        "daily_trend": daily_trend(shared),
        "monthly_active": active_customers(shared, "month"),
        "daily_active": active_customers(shared, "day"),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
    spark = mart.sparkSession
    written = export_metadata(
        spark.read.parquet(f"{folder}/mart_customer_360"),
        spark.read.parquet(f"{folder}/daily_trend"),
    )
    written.write.mode("overwrite").json(f"{folder}/meta")
    return spark.read.schema(written.schema).json(f"{folder}/meta")
