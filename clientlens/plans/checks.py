"""Verification queries over the layers: counts, audit, completeness, leaks and totals."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientlens.functions.masking import MASKED_NAME_PATTERN, is_raw_email, is_raw_name
from clientlens.functions.money import exact

# Columns that must never appear in the mart.
FORBIDDEN_COLUMNS = ("phone", "email", "id_number")


def table_counts(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Row count of every table; a table that cannot be read gets its error instead."""
    counted = []
    for name, open_table in tables.items():
        try:
            rows = open_table().agg(F.count(F.lit(1)).alias("n"))
            error = F.lit(None).cast("string")
        except (AnalysisException, ValueError) as exc:  # ValueError: the table was never loaded
            rows = spark.range(1).select(F.lit(None).cast("bigint").alias("n"))
            error = F.lit(str(exc).splitlines()[0])
        counted.append(rows.select(F.lit(name).alias("table_name"), "n", error.alias("error")))
    result = counted[0]
    for frame in counted[1:]:
        result = result.unionByName(frame)
    return result


def recent_audit(audit: DataFrame, k: int = 20) -> DataFrame:
    """The latest runs, newest first."""
    return (
        audit.select(
            "batch_id", "table_name", "run_mode", "status", "rows_ingested", "current_run_time"
        )
        .orderBy(F.desc("current_run_time"), "table_name", "batch_id")
        .limit(k)
    )


def mart_completeness(mart: DataFrame, history: DataFrame) -> DataFrame:
    """Per snapshot: mart rows, distinct customers, and whether both match the customers that were
    current when it was loaded.

    ``history`` holds the versions of the customer dimension. A version adds a customer when it
    begins and takes one away when it ends; the sums per moment, of which there are as many as runs,
    are added up to each load.
    """
    per_customer = mart.groupBy("snapshot_date", "customer_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max("_gold_loaded_at").alias("loaded")
    )
    snapshots = per_customer.groupBy("snapshot_date").agg(
        F.sum("rows").alias("mart_rows"),
        F.count(F.lit(1)).alias("mart_customers"),
        F.max("loaded").alias("moment"),
    )
    begins = F.struct(F.col("effective_from").alias("moment"), F.lit(1).alias("change"))
    ends = F.struct(F.col("effective_to").alias("moment"), F.lit(-1).alias("change"))
    moves = history.select(F.inline(F.array(begins, ends))).filter("moment IS NOT NULL")
    moves = moves.groupBy("moment").agg(F.sum("change").alias("change"))
    line = moves.unionByName(snapshots, allowMissingColumns=True)
    so_far = Window.orderBy("moment", F.col("snapshot_date").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    known = F.coalesce(F.sum("change").over(so_far), F.lit(0))
    return (
        line.withColumn("current_customers", known)
        .filter("mart_rows IS NOT NULL")
        .select(
            "snapshot_date",
            "mart_rows",
            "mart_customers",
            "current_customers",
            (
                (F.col("mart_rows") == F.col("current_customers"))
                & (F.col("mart_customers") == F.col("current_customers"))
            ).alias("complete"),
        )
    )


def rfm_distribution(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg(exact(F.col("monetary_12m"))).cast("double"), 0).alias("avg_monetary"),
            F.round(F.avg("recency_days"), 0).alias("avg_recency"),
        )
        .orderBy(F.desc("n"), "rfm_segment")
    )


def cross_sell_counts(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count_if("cross_sell_loan_flag").alias("loan_candidates"),
        F.count_if("cross_sell_card_flag").alias("card_candidates"),
        F.count_if("cross_sell_invest_flag").alias("invest_candidates"),
        F.count_if("has_npl_loan").alias("npl_customers"),
    )


def segment_net_asset(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg(exact(F.col("net_asset_value"))).cast("double"), 0).alias("avg_net_asset"),
            F.round(F.avg("total_product_count"), 2).alias("avg_products"),
        )
        .orderBy(F.desc("avg_net_asset"), "customer_segment")
    )


def pii_leaks(mart: DataFrame) -> DataFrame:
    """Unmasked names, unmasked e-mails and forbidden columns of the mart; all should be 0."""
    forbidden = [c for c in mart.columns if c.lower() in FORBIDDEN_COLUMNS]
    return mart.agg(
        F.count_if(is_raw_name(F.col("full_name"))).alias("raw_name_leak"),
        F.count_if(is_raw_email(F.col("email_masked"))).alias("raw_email_leak"),
        F.lit(len(forbidden)).cast("bigint").alias("forbidden_columns"),
    )


def pii_sample(mart: DataFrame, k: int = 10) -> DataFrame:
    """A few masked rows to look at."""
    return (
        mart.select("customer_id", "full_name", "phone_masked", "email_masked", "snapshot_date")
        .orderBy("customer_id", "snapshot_date")
        .limit(k)
    )


def masked_by_snapshot(mart: DataFrame) -> DataFrame:
    """Rows and masked rows of every snapshot."""
    return (
        mart.groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("full_name").like(MASKED_NAME_PATTERN)).alias("masked"),
        )
        .orderBy("snapshot_date")
    )
