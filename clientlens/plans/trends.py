"""Transaction trends and active customers per day and month."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.functions.money import exact, total
from clientlens.plans.activity import tagged_accounts, tagged_facts
from clientlens.sources.scratch import materialise

# The channels a trend is split into, in display order.
CHANNELS = ("ONLINE", "ATM", "POS", "BRANCH")
_LABEL_FORMAT = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


def customer_days(
    bank: DataFrame,
    card: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Count and amount of the completed transactions of each current customer, per day, source and
    channel, with the customer's segment.

    All trends derive from this frame, so the facts are read, joined and reduced once; the owners
    are looked up among the dimensions first. An account has few transactions per day and channel,
    so counting them before the join would shuffle the facts once more without making them
    smaller. The partitions of a hot account are split by Spark's skew join instead, and the
    aggregate on top combines on the map side.
    """
    facts = tagged_facts(bank, card).select(
        "source",
        "account_id",
        F.col("txn_date").alias("day"),
        "channel",
        exact(F.col("amount")).alias("amount"),
    )
    current = customers.filter("is_current").select("customer_id", "customer_segment")
    owners = tagged_accounts(accounts, cards).join(current, "customer_id")
    return (
        facts.join(owners, ["source", "account_id"])
        .groupBy("day", "source", "channel", "customer_segment", "customer_id")
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("amount"))
    )


def customer_numbers(customers: DataFrame) -> DataFrame:
    """Current customers with their segment and a number for bitmaps, stored. Numbers begin at 1 and are
    dense within each range of ids that one task numbers."""
    current = customers.filter("is_current").select("customer_id", "customer_segment")
    numbered = current.repartitionByRange("customer_id").withColumn("number", F.monotonically_increasing_id() + 1)
    return materialise(numbered, "customer-numbers")


def active_bitmaps(bank: DataFrame, card: DataFrame, accounts: DataFrame, cards: DataFrame, numbers: DataFrame) -> DataFrame:
    """Who had a completed transaction, per day, segment and bucket of 32,768 customer numbers: one bit
    for each customer. Bitmaps are merged by OR, so counts of any span, segment or bucket come from them.

    Facts become narrow rows, one for each day and customer, and meet in the task of their bitmap before
    it is built. A task of the facts sees few customers of any bitmap, so bitmaps built there would be
    nearly as many as its facts, at 4 KB each, and all of them would be shuffled and sorted.
    """
    facts = tagged_facts(bank, card).select("source", "account_id", F.col("txn_date").alias("day"))
    owners = tagged_accounts(accounts, cards).join(numbers, "customer_id").select("source", "account_id", "customer_segment", "number")
    active = facts.join(owners, ["source", "account_id"]).select("day", "customer_segment", "number").distinct()
    return (
        active.withColumn("bucket", F.bitmap_bucket_number("number"))
        .repartition("day", "customer_segment", "bucket")
        .groupBy("day", "customer_segment", "bucket")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("customers"))
    )


def active_from_bitmaps(bitmaps: DataFrame, grain: str | None, by: Sequence[str] = ("customer_segment",)) -> DataFrame:
    """Exact distinct active customers per day or month (or of all days, without a grain) and ``by``."""
    spans = [] if grain is None else [(F.col("day") if grain == "day" else F.trunc("day", "month")).alias(grain)]
    keys = [*([] if grain is None else [grain]), *by]
    merged = bitmaps.groupBy(*spans, *by, "bucket").agg(F.bitmap_or_agg("customers").alias("customers"))
    counted = F.coalesce(F.sum(F.bitmap_count("customers")), F.lit(0).cast("long"))
    return merged.groupBy(*keys).agg(counted.alias("active_customers"))


def day_partials(bank: DataFrame, card: DataFrame, accounts: DataFrame, cards: DataFrame, customers: DataFrame) -> DataFrame:
    """Count and exact amount per day, source, channel and segment. They add up, so a day's rows can be
    replaced without looking at other days."""
    current = customers.filter("is_current").select("customer_id", "customer_segment")
    owners = tagged_accounts(accounts, cards).join(current, "customer_id").select("source", "account_id", "customer_segment")
    facts = tagged_facts(bank, card).select(
        "source", "account_id", F.col("txn_date").alias("day"), "channel", exact(F.col("amount")).alias("amount")
    )
    return (
        facts.join(owners, ["source", "account_id"])
        .groupBy("day", "source", "channel", "customer_segment")
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("amount"))
    )


def touched_days(*deliveries: DataFrame) -> list[date | None]:
    """The days that deliveries of facts have rows for: as many as the calendar has at most."""
    days = reduce(DataFrame.union, [d.select("txn_date") for d in deliveries]).distinct()
    return [r[0] for r in days.collect()]


def on_days(column: str, days: Sequence[date | None]) -> Column:
    """A filter for the rows of some days; constants, which reach the scan, so that files are skipped."""
    known = F.col(column).isin([d for d in days if d is not None])
    return known | F.col(column).isNull() if None in days else known


def refreshed(stored: DataFrame, rebuild: Callable[[DataFrame, DataFrame], DataFrame], bank: DataFrame, card: DataFrame, days: Sequence[date | None]) -> DataFrame:
    """Stored day partials (sums or bitmaps) with those of some days made anew from the facts of these
    days only."""
    kept = stored.filter(~F.coalesce(on_days("day", days), F.lit(False)))
    facts = [f.filter(on_days("txn_date", days)) for f in (bank, card)]
    return kept.unionByName(rebuild(*facts).select(*stored.columns))


def daily_trend(days: DataFrame) -> DataFrame:
    """Transaction count and amount per day, source, channel and segment."""
    return days.groupBy("day", "source", "channel", "customer_segment").agg(
        F.sum("txn_count").alias("txn_count"), F.sum("amount").cast("double").alias("txn_amount")
    )


def active_customers(days: DataFrame, grain: str) -> DataFrame:
    """Distinct customers with a transaction per day or month and segment, from customer days; see
    :func:`active_from_bitmaps` for counts that are shared between grains.
    """
    bucket = F.col("day") if grain == "day" else F.trunc("day", "month")
    return days.groupBy(bucket.alias(grain), "customer_segment").agg(
        F.count_distinct("customer_id").alias("active_customers")
    )


def _label(column: str, grain: str):
    return F.date_format(column, _LABEL_FORMAT[grain]).alias("x")


def txn_trend(trend: DataFrame, grain: str) -> DataFrame:
    """Amount in billions and count per day or month, rolled up from the daily trend."""
    return (
        trend.groupBy(_label("day", grain))
        .agg((total(F.col("txn_amount")) / 1e9).alias("amt"), F.sum("txn_count").alias("cnt"))
        .orderBy("x")
    )


def active_trend(active: DataFrame, grain: str) -> DataFrame:
    """Active customers over all segments per day or month."""
    return active.groupBy(_label(grain, grain)).agg(F.sum("active_customers").alias("n")).orderBy("x")


def channel_trend(
    trend: DataFrame, grain: str, channels: Sequence[str] = CHANNELS
) -> DataFrame:
    """Transaction count per day or month with one column per channel, 0 where there is none.

    Only ``channels`` are shown: transactions of others, and those without a channel, have no column.
    """
    return (
        trend.groupBy(_label("day", grain))
        .pivot("channel", list(channels))
        .agg(F.sum("txn_count"))
        .fillna(0)
        .orderBy("x")
    )
