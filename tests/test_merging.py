"""Figures that add up: bitmaps, day partials, several dates from one scan, as-of joins without pairs."""

import random
import re
from bisect import bisect_right
from datetime import date, datetime, timedelta

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from clientlens.config import GoldSettings
from clientlens.operators.scd import join_as_of
from clientlens.plans import activity, trends

BANK = "txn_id string, account_id string, txn_date date, amount double, channel string, status string"
CARD = BANK + ", merchant_category string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Facts as files, so that plans show what is read."""
    pick, folder = random.Random(2), str(tmp_path_factory.mktemp("facts"))
    start = date(2023, 1, 1)

    def facts(kind, n, *more):
        rows = []
        for i in range(n):
            # One account has a third of all rows.
            account = f"{kind}1" if i % 3 == 0 else f"{kind}{pick.randrange(40)}"
            day = None if i % 97 == 0 else start + timedelta(days=pick.randrange(700))
            status = pick.choice(["COMPLETED"] * 4 + ["PENDING"])
            rows.append((f"{kind}{i}", account, day, pick.randrange(1, 9999) / 100, pick.choice(["ONLINE", "ATM", None]), status, *(f() for f in more)))
        return rows

    spark.createDataFrame(facts("b", 3000), BANK).write.parquet(f"{folder}/bank")
    spark.createDataFrame(facts("c", 2000, lambda: pick.choice(["FOOD", "BOOKS", None])), CARD).write.parquet(f"{folder}/card")
    accounts = spark.createDataFrame([(f"b{i}", f"C{i % 25}") for i in range(40)], "account_id string, customer_id string")
    cards = spark.createDataFrame([(f"c{i}", f"C{i % 30}") for i in range(40)], "account_id string, customer_id string")
    people = [(f"C{i}", ("MASS", "PREMIER", None)[i % 3], i != 7) for i in range(30)]
    customers = spark.createDataFrame(people, "customer_id string, customer_segment string, is_current boolean")
    return spark.read.parquet(f"{folder}/bank"), spark.read.parquet(f"{folder}/card"), accounts, cards, customers


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_count_what_a_distinct_count_does(tables):
    bank, card, accounts, cards, customers = tables
    days = trends.customer_days(bank, card, accounts, cards, customers)
    bitmaps = trends.active_bitmaps(bank, card, accounts, cards, trends.customer_numbers(customers))
    for grain in ("day", "month"):
        assert rows_of(trends.active_from_bitmaps(bitmaps, grain)) == rows_of(trends.active_customers(days, grain))
    span = F.col("day").between(date(2023, 5, 1), date(2023, 8, 15))
    got = trends.active_from_bitmaps(bitmaps.filter(span), None, ()).first()["active_customers"]
    assert got == days.filter(span).select("customer_id").distinct().count()
    assert trends.active_from_bitmaps(bitmaps.filter("false"), None, ()).first()["active_customers"] == 0


def test_refreshed_days_equal_a_rebuild_and_others_are_not_read(spark, tables):
    bank, card, accounts, cards, customers = tables
    numbers = trends.customer_numbers(customers)
    late = bank.filter("txn_date BETWEEN '2024-03-01' AND '2024-03-09' OR txn_date IS NULL")
    days = trends.touched_days(late)
    assert None in days and len(days) <= 10
    first = bank.join(late.select("txn_id"), "txn_id", "left_anti")
    builds = (
        lambda b, c: trends.day_partials(b, c, accounts, cards, customers),
        lambda b, c: trends.active_bitmaps(b, c, accounts, cards, numbers),
    )
    for build in builds:
        now = trends.refreshed(build(first, card), build, bank, card, days)
        assert rows_of(now) == rows_of(build(bank, card))
    # The days reach the scans of both facts.
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    pushed = re.findall(r"PushedFilters: \[.*?In\(txn_date", plan_of(now))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(pushed) >= 2


def test_several_dates_from_one_scan(tables):
    bank, card, accounts, cards, _ = tables
    dates = [date(2024, 2, 29), date(2024, 11, 30), date(2024, 11, 15), date(2022, 12, 31)]
    for settings in (GoldSettings(), GoldSettings(lookback_months=70), GoldSettings(lookback_months=1)):
        many = activity.customer_activities(bank, card, accounts, cards, dates, settings)
        for day in dates:
            one = activity.customer_activity(bank, card, accounts, cards, day, settings)
            assert rows_of(many.filter(F.col("as_of") == day).drop("as_of")) == rows_of(one)
    assert plan_of(many).count("FileScan parquet") == 2


@pytest.mark.parametrize("slice_facts", [1_000_000, 50])
def test_as_of_join_of_a_hot_key_with_many_versions(spark, slice_facts):
    pick, start = random.Random(8), datetime(2020, 1, 1)
    history, facts = [], []
    for key, n in (("hot", 1000), ("few", 3), ("open", 1), ("late", 1)):
        begins = sorted(pick.sample(range(0, 4000), n))
        for i, at in enumerate(begins):
            # Some versions end before the next one begins.
            end = begins[i + 1] - (1 if i % 5 == 0 else 0) if i + 1 < n else None
            history.append((key, start + timedelta(hours=at), None if end is None else start + timedelta(hours=max(end, at)), f"{key}{i}"))
    for i in range(1500):
        key = "hot" if i % 3 == 0 else pick.choice(["few", "open", "unknown", None])
        at = None if i % 101 == 0 else start + timedelta(hours=pick.randrange(-100, 4100))
        facts.append((i, key, at))
    facts += [(10_000 + i, "late", start - timedelta(days=9)) for i in range(80)]
    frame = spark.createDataFrame(facts, "id int, k string, at timestamp")
    versions = spark.createDataFrame(history, "k string, effective_from timestamp, effective_to timestamp, v string")
    found = {r.id: r.v for r in join_as_of(frame, versions, "k", "at", ["v"], slice_facts).collect()}
    by_key = {}
    for key, low, high, v in sorted(history, key=lambda h: h[:2]):
        by_key.setdefault(key, []).append((low, high, v))
    for i, key, at in facts:
        own = by_key.get(key, [])
        place = bisect_right([low for low, *_ in own], at) - 1 if at is not None else -1
        wanted = own[place][2] if place >= 0 and (own[place][1] is None or at < own[place][1]) else None
        assert found[i] == wanted
    assert len(found) == len(facts)
