"""Column expressions for RFM segments, cross-sell rules and reporting bands."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

# Segment names from most to least valuable.
RFM_ORDER = (
    "Champions",
    "Loyal",
    "Potential_Loyal",
    "New",
    "Need_Attention",
    "At_Risk",
    "Hibernating",
)
# Rank of a segment name that is not listed.
UNKNOWN_SEGMENT_RANK = 99


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Segment of a score triple; the most valuable matching description wins."""
    frequent, recent, lapsed = f >= 4, r >= 4, r <= 2
    return (
        F.when(frequent, F.when(recent & (m >= 4), "Champions").otherwise("Loyal"))
        .when(recent, F.when(f >= 2, "Potential_Loyal").otherwise("New"))
        .when(lapsed, F.when(f >= 3, "At_Risk").otherwise("Hibernating"))
        .otherwise("Need_Attention")
    )


def rfm_rank(segment: Column) -> Column:
    """Position of a segment in RFM_ORDER, for sorting."""
    ranks = F.create_map(*[F.lit(v) for i, s in enumerate(RFM_ORDER, 1) for v in (s, i)])
    return F.coalesce(ranks[segment], F.lit(UNKNOWN_SEGMENT_RANK))


def with_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Add one boolean column per rule text, evaluated over the frame's own columns.

    NULL inputs follow SQL logic, so a flag can be NULL. A rule that is not boolean is an error.
    """
    flagged = df.withColumns({name: F.expr(text) for name, text in rules.items()})
    for name in rules:
        if not isinstance(flagged.schema[name].dataType, BooleanType):
            raise ValueError(f"rule {name} is not a condition: {rules[name]}")
    return flagged


def _banded(value: Column, upper_bounds: list[tuple[float, str]], last: str) -> Column:
    (bound, label), *rest = upper_bounds
    band = F.when(value < bound, label)
    for bound, label in rest:
        band = band.when(value < bound, label)
    return band.otherwise(last)


# The labels below are shown to report readers as they are.
# A missing age or tenure counts as 0, as it does in the report's own expressions.
def age_band(age: Column) -> Column:
    return _banded(
        F.coalesce(age, F.lit(0)),
        [(25, "1. <25"), (35, "2. 25-34"), (45, "3. 35-44"), (55, "4. 45-54"), (65, "5. 55-64")],
        "6. 65+",
    )


def tenure_band(days: Column) -> Column:
    return _banded(
        F.coalesce(days, F.lit(0)),
        [(365, "1. <1 năm"), (1095, "2. 1-3 năm"), (1825, "3. 3-5 năm")],
        "4. 5+ năm",
    )


def deposit_band(balance: Column) -> Column:
    positive = _banded(
        balance,
        [(5e7, "1. <50tr"), (2e8, "2. 50-200tr"), (5e8, "3. 200-500tr"), (1e9, "4. 500tr-1 tỷ")],
        "5. 1 tỷ+",
    )
    return F.when(balance == 0, "0. Không gửi").otherwise(positive)


def utilisation_band(rate: Column) -> Column:
    used = _banded(rate, [(0.3, "1. <30%"), (0.6, "2. 30-60%"), (0.9, "3. 60-90%")], "4. ≥90%")
    return F.when(rate == 0, "0%").otherwise(used)


def engagement_status(recency_days: Column) -> Column:
    return (
        F.when(recency_days.isNull(), "Chưa GD")
        .when(recency_days <= 30, "1. Rất tích cực (≤30d)")
        .when(recency_days <= 90, "2. Tích cực (31-90d)")
        .when(recency_days <= 180, "3. Nguội (91-180d)")
        .otherwise("4. Ngủ đông (>180d)")
    )


def digital_persona(ratio: Column) -> Column:
    return (
        F.when(ratio >= 0.8, "Digital-native")
        .when(ratio >= 0.5, "Digital-first")
        .when(ratio > 0, "Hybrid")
        .otherwise("Truyền thống")
    )
