"""Saved lists for marketing and sales, and lookups of single customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Segments that campaigns address.
CAMPAIGN_SEGMENTS = ("Champions", "Loyal", "At_Risk", "Hibernating")


def marketing_list(rows: DataFrame) -> DataFrame:
    """Customers of the campaign segments, highest spend first within a segment."""
    return (
        rows.filter(F.col("rfm_segment").isin(list(CAMPAIGN_SEGMENTS)))
        .select(
            "customer_id",
            "full_name",
            "customer_segment",
            "rfm_segment",
            "rfm_score",
            "recency_days",
            "frequency_12m",
            "monetary_12m",
            "last_txn_date",
        )
        .orderBy("rfm_segment", F.desc("monetary_12m"), "customer_id")
    )


def sales_list(rows: DataFrame) -> DataFrame:
    """Customers with any cross-sell opportunity, richest first."""
    flags = ["cross_sell_loan_flag", "cross_sell_card_flag", "cross_sell_invest_flag"]
    return (
        rows.filter(" OR ".join(flags))
        .select(
            "customer_id",
            "full_name",
            "customer_segment",
            "net_asset_value",
            "total_deposit_balance",
            *flags,
        )
        .orderBy(F.desc("net_asset_value"), "customer_id")
    )


def customer_lookup(df: DataFrame, customer_id: str) -> DataFrame:
    """All rows of one customer."""
    return df.filter(F.col("customer_id") == customer_id)
