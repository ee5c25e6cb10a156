"""Named report measures over one snapshot of the mart.

A snapshot holds one row per customer, so counting rows counts customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.functions import segments
from clientlens.functions.money import total

_BILLION = 1e9
_MILLION = 1e6


def _count() -> Column:
    return F.count(F.lit(1))


def _rate(condition: Column) -> Column:
    return F.try_divide(F.count_if(condition), _count())


def with_bands(rows: DataFrame) -> DataFrame:
    """Add the report's banding columns."""
    return rows.withColumns(
        {
            "age_band": segments.age_band(F.col("age")),
            "tenure_years": F.col("tenure_days") / 365.25,
            "tenure_band": segments.tenure_band(F.col("tenure_days")),
            "aum_band": segments.deposit_band(F.col("total_deposit_balance")),
            "engagement_status": segments.engagement_status(F.col("recency_days")),
            "digital_persona": segments.digital_persona(F.col("digital_txn_ratio")),
            "rfm_sort": segments.rfm_rank(F.col("rfm_segment")),
        }
    )


def kpi_measures() -> dict[str, Column]:
    deposits = total(F.col("total_deposit_balance"))
    loans = total(F.col("total_loan_outstanding"))
    net = total(F.col("net_asset_value"))
    return {
        "total_customers": _count(),
        "total_aum": deposits,
        "total_aum_billion": deposits / _BILLION,
        "total_loan_outstanding": loans,
        "total_loan_billion": loans / _BILLION,
        "total_nav": net,
        "total_nav_billion": net / _BILLION,
        "avg_products_per_customer": F.avg("total_product_count"),
        "total_txn_amount_12m_billion": total(F.col("txn_amount_12m")) / _BILLION,
        "total_txn_count_12m": F.sum("txn_count_12m"),
        "avg_aum_per_customer_million": F.try_divide(deposits, _count()) / _MILLION,
    }


def product_measures() -> dict[str, Column]:
    flags = {
        "savings": "has_savings",
        "current": "has_current",
        "card": "has_credit_card",
        "loan": "has_loan",
    }
    multi = F.col("total_product_count") >= 3
    return {
        **{f"{name}_holders": F.count_if(flag) for name, flag in flags.items()},
        **{f"{name}_penetration": _rate(F.col(flag)) for name, flag in flags.items()},
        "single_product_customers": F.count_if(F.col("total_product_count") == 1),
        "multi_product_customers": F.count_if(multi),
        "multi_product_rate": _rate(multi),
    }


def rfm_measures() -> dict[str, Column]:
    segment = F.col("rfm_segment")
    return {
        "champions": F.count_if(segment == "Champions"),
        "at_risk": F.count_if(segment == "At_Risk"),
        "hibernating": F.count_if(segment == "Hibernating"),
        "champions_rate": _rate(segment == "Champions"),
        "at_risk_rate": _rate(segment == "At_Risk"),
        "avg_r": F.avg("r_score"),
        "avg_f": F.avg("f_score"),
        "avg_m": F.avg("m_score"),
    }


def digital_measures() -> dict[str, Column]:
    recency = F.col("recency_days")
    digital_first = F.col("digital_txn_ratio") >= 0.5
    return {
        "avg_digital_ratio": F.avg("digital_txn_ratio"),
        "digital_first_customers": F.count_if(digital_first),
        "digital_first_rate": _rate(digital_first),
        "active_customers_90d": F.count_if(recency <= 90),
        "activity_rate": _rate(recency <= 90),
        "dormant_customers": F.count_if(recency.isNull() | (recency > 180)),
        "avg_monthly_spend_million": F.avg("avg_monthly_spend") / _MILLION,
        "avg_active_months_12m": F.avg("active_months_12m"),
    }


def risk_measures() -> dict[str, Column]:
    overdue = F.col("days_past_due")
    leads = {name: F.col(f"cross_sell_{name}_flag") for name in ("loan", "card", "invest")}
    return {
        "npl_customers": F.count_if("has_npl_loan"),
        "npl_rate_of_customers": _rate(F.col("has_npl_loan")),
        "npl_rate_of_borrowers": F.try_divide(F.count_if("has_npl_loan"), F.count_if("has_loan")),
        "avg_days_past_due": F.avg(F.when(overdue > 0, overdue)),
        "avg_credit_utilization": F.avg(
            F.when(F.col("has_credit_card"), F.col("credit_utilization_rate"))
        ),
        **{f"{name}_leads": F.count_if(flag) for name, flag in leads.items()},
        **{f"{name}_lead_rate": _rate(flag) for name, flag in leads.items()},
        "any_lead": F.count_if(leads["loan"] | leads["card"] | leads["invest"]),
    }


def average_measures() -> dict[str, Column]:
    return {"avg_age": F.avg("age"), "avg_tenure_years": F.avg(F.col("tenure_days") / 365.25)}


def measure(rows: DataFrame, measures: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """Evaluate measures over the whole slice, or per group of the given columns."""
    columns = [column.alias(name) for name, column in measures.items()]
    return rows.groupBy(*by).agg(*columns)


def customers_by(rows: DataFrame, *columns: str) -> DataFrame:
    """Customers per combination of columns; the frame may carry the banding columns."""
    return rows.groupBy(*columns).agg(_count().alias("customers"))


def top_provinces(rows: DataFrame, k: int = 10) -> DataFrame:
    return customers_by(rows, "province").orderBy(F.desc("customers"), "province").limit(k)


def segment_matrix(rows: DataFrame) -> DataFrame:
    """Penetration rates and products per customer of every customer segment."""
    products, basic = product_measures(), kpi_measures()
    chosen = {f"{n}_penetration": products[f"{n}_penetration"] for n in ("savings", "card", "loan")}
    chosen["avg_products_per_customer"] = basic["avg_products_per_customer"]
    return measure(rows, chosen, ("customer_segment",))


def rfm_matrix(rows: DataFrame) -> DataFrame:
    """Customers per recency score, with one column per frequency score."""
    return (
        rows.groupBy("r_score")
        .pivot("f_score", [1, 2, 3, 4, 5])
        .agg(_count())
        .fillna(0)
        .select("r_score", *[F.col(str(i)).alias(f"f{i}") for i in range(1, 6)])
        .orderBy("r_score")
    )


def value_by_rfm(rows: DataFrame) -> DataFrame:
    """Deposits and transaction amount in billions of every RFM segment."""
    basic = kpi_measures()
    chosen = {k: basic[k] for k in ("total_aum_billion", "total_txn_amount_12m_billion")}
    return measure(rows, chosen, ("rfm_segment",))


def recency_histogram(rows: DataFrame, width: int = 30) -> DataFrame:
    """Customers per recency bin; customers without transactions form a bin of their own."""
    low = (F.floor(F.col("recency_days") / width) * width).cast("int").alias("recency_from")
    return rows.groupBy(low).agg(_count().alias("customers")).orderBy("recency_from")


def champions_list(rows: DataFrame) -> DataFrame:
    return (
        rows.filter("rfm_segment = 'Champions'")
        .select("customer_id", "customer_segment", "total_deposit_balance", "total_product_count")
        .orderBy(F.desc("total_deposit_balance"), "customer_id")
    )


def invest_list(rows: DataFrame) -> DataFrame:
    return (
        rows.filter("cross_sell_invest_flag")
        .select("customer_id", "customer_segment", "net_asset_value", "total_deposit_balance")
        .orderBy(F.desc("net_asset_value"), "customer_id")
    )


def customer_points(rows: DataFrame) -> DataFrame:
    """Per-customer values behind the scatter charts."""
    return rows.select(
        "customer_id",
        "customer_segment",
        "rfm_segment",
        "total_deposit_balance",
        "total_product_count",
        "recency_days",
        "monetary_12m",
        "frequency_12m",
        "total_loan_outstanding",
        "days_past_due",
        "has_npl_loan",
    )
