"""Filters that reports apply to the mart and to the trend tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_snapshot(mart: DataFrame) -> DataFrame:
    """Rows of the latest snapshot date."""
    newest = mart.select(F.max("snapshot_date")).scalar()
    return mart.filter(F.col("snapshot_date") == newest)


def mart_slice(
    mart: DataFrame,
    snapshot: date | None = None,
    segment: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """One snapshot (the latest by default), optionally one customer segment and a condition."""
    rows = latest_snapshot(mart) if snapshot is None else mart.filter(F.col("snapshot_date") == snapshot)
    if segment is not None:
        rows = rows.filter(F.col("customer_segment") == segment)
    return rows if where is None else rows.filter(where)


def trend_slice(
    trend: DataFrame,
    day: str,
    first_month: date | None = None,
    last_month: date | None = None,
    segment: str | None = None,
) -> DataFrame:
    """Trend rows of a range of whole months, optionally of one customer segment.

    The bounds are compared with the day column itself, so they can prune partitions.
    """
    rows = trend
    if first_month is not None:
        rows = rows.filter(F.col(day) >= F.trunc(F.lit(first_month), "month"))
    if last_month is not None:
        rows = rows.filter(F.col(day) <= F.last_day(F.lit(last_month)))
    return rows if segment is None else rows.filter(F.col("customer_segment") == segment)
