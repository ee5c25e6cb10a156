"""The customer mart: one row per current customer and snapshot date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.config import GoldSettings
from clientlens.functions.masking import mask_email, mask_name, mask_phone
from clientlens.functions.segments import rfm_segment, with_rules
from clientlens.operators.ranking import with_buckets
from clientlens.schemas import GOLD
from clientlens.sources.scratch import materialise

SCORE_BUCKETS = 5
# Recency assumed for a customer without transactions when scoring.
NEVER_ACTIVE_DAYS = 999999

_DEFAULTS = {
    "total_product_count": 0,
    "has_savings": False,
    "has_current": False,
    "has_credit_card": False,
    "has_loan": False,
    "total_deposit_balance": 0.0,
    "total_loan_outstanding": 0.0,
    "credit_utilization_rate": 0.0,
    "net_asset_value": 0.0,
    "has_npl_loan": False,
    "days_past_due": 0,
    "txn_count_12m": 0,
    "txn_amount_12m": 0.0,
    "avg_monthly_spend": 0.0,
    "digital_txn_ratio": 0.0,
    "active_months_12m": 0,
    "frequency_12m": 0,
    "monetary_12m": 0.0,
}

MART_COLUMNS = [f.name for f in GOLD["mart_customer_360"] if not f.name.startswith("_gold")]


def age_in_years(as_of: date, born: Column) -> Column:
    """Completed years of age."""
    return F.floor(F.months_between(F.lit(as_of), born) / 12).cast("int")


def tenure_days(as_of: date) -> Column:
    """Days since the first product was opened."""
    return F.datediff(F.lit(as_of), "first_open_date")


def _figures(aggregate: DataFrame, table: str) -> DataFrame:
    """The aggregate without its load metadata."""
    return aggregate.select([f.name for f in GOLD[table] if not f.name.startswith("_gold")])


def mart_base(
    customers: DataFrame, holdings: DataFrame, activity: DataFrame, as_of: date
) -> DataFrame:
    """Current customers with their holdings and activity; absent figures get their defaults.

    Personal data is masked here, so what is stored from here on has none of it in the open.
    """
    identity = customers.filter("is_current").select(
        "customer_id",
        mask_name(F.col("full_name")).alias("full_name"),
        mask_phone(F.col("phone")).alias("phone_masked"),
        mask_email(F.col("email")).alias("email_masked"),
        age_in_years(as_of, F.col("date_of_birth")).alias("age"),
        "gender",
        "customer_segment",
        "kyc_status",
        "city",
        "province",
    )
    return (
        identity.join(_figures(holdings, "agg_customer_holdings"), "customer_id", "left")
        .join(_figures(activity, "agg_customer_txn_12m"), "customer_id", "left")
        .fillna(_DEFAULTS)
        .withColumn("tenure_days", tenure_days(as_of))
    )


def with_rfm(base: DataFrame) -> DataFrame:
    """Add the three scores, their concatenation and the segment.

    Recent, frequent and high-spending customers score high; customers with equal figures
    are ordered by id. ``base`` should be stored, as it is read more than once.
    """
    scored = with_buckets(
        base,
        "customer_id",
        {
            "r_score": -F.coalesce("recency_days", F.lit(NEVER_ACTIVE_DAYS)),
            "f_score": F.col("frequency_12m"),
            "m_score": F.col("monetary_12m"),
        },
        SCORE_BUCKETS,
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumns(
        {
            "rfm_score": F.concat(r.cast("string"), f.cast("string"), m.cast("string")),
            "rfm_segment": rfm_segment(r, f, m),
        }
    )


def finish_mart(scored: DataFrame, as_of: date, settings: GoldSettings) -> DataFrame:
    """Apply the cross-sell rules and stamp the snapshot date."""
    dated = with_rules(scored, settings.cross_sell).withColumn("snapshot_date", F.lit(as_of))
    return dated.select(*MART_COLUMNS)


def customer_mart(
    customers: DataFrame,
    holdings: DataFrame,
    activity: DataFrame,
    as_of: date,
    settings: GoldSettings,
) -> DataFrame:
    """The finished mart of one snapshot date."""
    base = materialise(mart_base(customers, holdings, activity, as_of), "mart-base")
    return finish_mart(with_rfm(base), as_of, settings)
