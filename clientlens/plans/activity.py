"""What customers did in the trailing window: counts, amounts, recency, channels, categories."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.config import GoldSettings
from clientlens.functions.money import exact

_WORD = 64


def tagged_facts(bank: DataFrame, card: DataFrame) -> DataFrame:
    """Completed transactions of both systems in one frame, tagged with their system."""
    columns = ["source", "account_id", "txn_date", "amount", "channel"]
    bank_rows = bank.filter("status = 'COMPLETED'").withColumn("source", F.lit("BANK"))
    card_rows = card.filter("status = 'COMPLETED'").withColumn("source", F.lit("CARD"))
    return bank_rows.select(*columns).unionByName(
        card_rows.select(*columns, "merchant_category"), allowMissingColumns=True
    )


def tagged_accounts(accounts: DataFrame, cards: DataFrame) -> DataFrame:
    """Owner of every account of both systems, whatever its status."""
    return (
        accounts.withColumn("source", F.lit("BANK"))
        .select("source", "account_id", "customer_id")
        .unionByName(
            cards.withColumn("source", F.lit("CARD")).select("source", "account_id", "customer_id")
        )
    )


def latest_transaction_date(bank: DataFrame, card: DataFrame) -> date:
    """Default as-of date: the latest transaction of either system, whatever its status."""
    latest = (
        bank.agg(F.max("txn_date").alias("d"))
        .unionByName(card.agg(F.max("txn_date").alias("d")))
        .agg(F.max("d"))
        .first()[0]
    )
    if latest is None:
        raise ValueError("no transactions: cannot derive the as-of date")
    return latest


def _month_words(txn_date: Column, as_of: date, lookback: int) -> list[Column]:
    """Bit sets of the months that occur in a group, 64 months to a word.

    Distinct months are then exact and mergeable with one bitwise OR per word, where a
    distinct count would expand every row.
    """
    first = as_of.year * 12 + as_of.month - lookback
    index = F.year(txn_date) * 12 + F.month(txn_date) - F.lit(first)
    words = []
    for low in range(0, lookback + 1, _WORD):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), index - F.lit(low))
        inside = (index >= low) & (index < low + _WORD)
        words.append(F.when(inside, bit).otherwise(F.lit(0).cast("long")))
    return words


def customer_activity(
    bank: DataFrame,
    card: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    as_of: date,
    settings: GoldSettings,
) -> DataFrame:
    """One row per customer with a completed transaction in the window ending at ``as_of``.

    The facts are read once. They are first reduced per account and category, combining on
    the map side, so neither a hot account nor a hot customer reaches the joins at fact size.
    """
    lookback = settings.lookback_months
    in_window = (F.col("txn_date") > F.add_months(F.lit(as_of), -lookback)) & (
        F.col("txn_date") <= F.lit(as_of)
    )
    words = _month_words(F.col("txn_date"), as_of, lookback)
    names = [f"months_{i}" for i in range(len(words))]
    digital = F.col("channel").isin(list(settings.digital_channels))

    per_account = (
        tagged_facts(bank, card)
        .filter(in_window)
        .groupBy("source", "account_id", "merchant_category")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(exact(F.col("amount"))).alias("amount"),
            F.count_if(digital).alias("digital"),
            F.max("txn_date").alias("last_date"),
            *[F.bit_or(w).alias(name) for w, name in zip(words, names)],
        )
    )
    merged = [
        F.sum("n").alias("n"),
        F.sum("amount").alias("amount"),
        F.sum("digital").alias("digital"),
        F.max("last_date").alias("last_date"),
        *[F.bit_or(name).alias(name) for name in names],
    ]
    # Dealt by customer once: both aggregates find the rows of a customer together.
    per_category = (
        per_account.join(tagged_accounts(accounts, cards), ["source", "account_id"])
        .repartition("customer_id")
        .groupBy("customer_id", "merchant_category")
        .agg(*merged)
    )
    favourite = F.when(
        F.col("merchant_category").isNotNull(),
        F.struct((-F.col("amount")).alias("a"), F.col("merchant_category").alias("c")),
    )
    per_customer = per_category.groupBy("customer_id").agg(
        F.min(favourite)["c"].alias("category"), *merged
    )
    return per_customer.select("customer_id", *_figures(F.lit(as_of), lookback, names))


def _figures(as_of: Column, lookback: int, months: list[str]) -> list[Column]:
    """The published figures of a customer from the merged ones."""
    amount = F.col("amount").cast("double")
    count = F.col("n").cast("int")
    return [
        count.alias("txn_count_12m"),
        amount.alias("txn_amount_12m"),
        (amount / lookback).alias("avg_monthly_spend"),
        reduce(add, [F.bit_count(name) for name in months]).cast("int").alias("active_months_12m"),
        F.col("category").alias("top_spend_category"),
        (F.col("digital") / F.col("n")).alias("digital_txn_ratio"),
        F.col("last_date").alias("last_txn_date"),
        F.datediff(as_of, "last_date").alias("recency_days"),
        count.alias("frequency_12m"),
        amount.alias("monetary_12m"),
    ]


def customer_activities(
    bank: DataFrame,
    card: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    as_ofs: Sequence[date],
    settings: GoldSettings,
) -> DataFrame:
    """:func:`customer_activity` of several dates with one scan of the facts, as ``as_of`` and its columns.

    Time is cut at the months and at the edges of all windows. No window ends within such a piece, so
    the partial figures of an account in a piece belong to a window as a whole or not at all. Facts
    become partials once; each partial then goes to the windows that hold it.
    """
    lookback = settings.lookback_months
    dates = sorted(set(as_ofs))
    day = F.col("txn_date")
    edges = [edge for d in dates for edge in (F.add_months(F.lit(d), -lookback), F.lit(d))]
    in_any = reduce(or_, [(day > low) & (day <= high) for low, high in zip(edges[::2], edges[1::2])])
    piece = reduce(add, [(day > edge).cast("int") for edge in edges])
    month = F.year(day) * 12 + F.month(day)
    digital = F.col("channel").isin(list(settings.digital_channels))
    partials = (
        tagged_facts(bank, card)
        .filter(in_any)
        .groupBy("source", "account_id", "merchant_category", month.alias("month"), piece.alias("piece"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(exact(F.col("amount"))).alias("amount"),
            F.count_if(digital).alias("digital"),
            F.max("txn_date").alias("last_date"),
        )
    )
    windows = F.array(
        *[
            F.struct(high.alias("as_of"), low.alias("low"), F.lit(d.year * 12 + d.month - lookback).alias("first"))
            for d, low, high in zip(dates, edges[::2], edges[1::2])
        ]
    )
    holding = F.filter(windows, lambda w: (F.col("last_date") > w.low) & (F.col("last_date") <= w.as_of))
    # Dealt by customer ahead of the copies for each window: both aggregates find the rows of a customer together.
    owned = partials.join(tagged_accounts(accounts, cards), ["source", "account_id"]).repartition("customer_id")
    placed = owned.select("customer_id", "merchant_category", "month", "n", "amount", "digital", "last_date", F.explode(holding).alias("w"))
    index = F.col("month") - F.col("w.first")
    words = {}
    for i, low in enumerate(range(0, lookback + 1, _WORD)):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), index - F.lit(low))
        words[f"months_{i}"] = F.when((index >= low) & (index < low + _WORD), bit).otherwise(F.lit(0).cast("long"))
    merged = [
        F.sum("n").alias("n"),
        F.sum("amount").alias("amount"),
        F.sum("digital").alias("digital"),
        F.max("last_date").alias("last_date"),
        *[F.bit_or(name).alias(name) for name in words],
    ]
    per_category = (
        placed.select(F.col("w.as_of").alias("as_of"), "*", *[w.alias(name) for name, w in words.items()])
        .groupBy("as_of", "customer_id", "merchant_category")
        .agg(*merged)
    )
    favourite = F.when(
        F.col("merchant_category").isNotNull(),
        F.struct((-F.col("amount")).alias("a"), F.col("merchant_category").alias("c")),
    )
    per_customer = per_category.groupBy("as_of", "customer_id").agg(F.min(favourite)["c"].alias("category"), *merged)
    return per_customer.select("as_of", "customer_id", *_figures(F.col("as_of"), lookback, list(words)))
