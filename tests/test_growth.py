"""What is stored, shuffled and sorted by the shared steps of reports, trends and loads."""

from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
import smallbank as sb
from helpers import rows_of
from pyspark.sql import functions as F

from clientlens import catalogue
from clientlens.config import SILVER_TABLES, SOURCE_TABLES, GoldSettings
from clientlens.jobs import conform, ingest
from clientlens.plans import activity, mart, trends

R1 = datetime(2024, 11, 1, tzinfo=timezone.utc)
BANK = "txn_id string, account_id string, txn_date date, amount double, channel string, status string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bank(spark, tmp_path_factory):
    """A bank over tables of a few rows; customer 3 is delivered twice, customer 4 has no orders."""
    folder = str(tmp_path_factory.mktemp("tables"))
    at = lambda i: datetime(1998, 8, 1) + timedelta(days=11 * i)
    rows = {
        "region": ([(0, "ASIA"), (1, None)], "r_regionkey int, r_name string"),
        "nation": ([(0, "VIETNAM", 0), (1, "PERU", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": (
            [(k, f"Customer#{k}", k % 2, 1000.5 * k, ("BUILDING", "MACHINERY", "OTHER")[k % 3]) for k in (1, 2, 3, 3, 4, 20)],
            "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        ),
        "part": ([(1, "TIN"), (2, "BRASS")], "p_partkey long, p_type string"),
        "orders": (
            [(i, (1, 2, 3, 20)[i % 4], "PFO"[i % 3], 100.25 * i, at(i), ("1-URGENT", "2-HIGH", "5-LOW")[i % 3]) for i in range(1, 61)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            [(i, 1 + i % 2, 1 + n % 2, 10.5 * i, "NR"[n % 2], "FO"[i % 5 == 0], at(i + n)) for i in range(1, 61) for n in (1, 1, 2)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return catalogue.Bank(spark, folder)


def test_dimensions_of_both_snapshots_are_conformed_once(bank, monkeypatch):
    plans, build = [], mart.customer_mart

    def watched(customers, held, active, as_of, settings):
        plans.append(plan_of(held) + plan_of(customers))
        return build(customers, held, active, as_of, settings)

    monkeypatch.setattr(mart, "customer_mart", watched)
    both = bank.snapshots
    assert len(plans) == 2 and not any("Window" in p for p in plans)
    monkeypatch.undo()
    for day in (catalogue.PREVIOUS, catalogue.AS_OF):
        got = both.filter(F.col("snapshot_date") == day).select(*mart.MART_COLUMNS)
        assert got.count() == 5 and rows_of(got) == rows_of(bank.build_mart(day))


def test_partials_are_dealt_before_they_are_copied_to_windows(spark):
    facts = [(f"t{i}", f"a{i % 7}", date(2024, 1, 1) + timedelta(days=i), 1.5, "ATM", "COMPLETED") for i in range(300)]
    bank_facts = spark.createDataFrame(facts, BANK)
    card_facts = bank_facts.withColumn("merchant_category", F.lit("FOOD"))
    accounts = spark.createDataFrame([(f"a{i}", f"C{i % 5}") for i in range(7)], "account_id string, customer_id string")
    dates = [date(2024, 3, 31), date(2024, 9, 30)]
    plan = plan_of(activity.customer_activities(bank_facts, card_facts, accounts, accounts, dates, GoldSettings()))
    assert "Exchange" not in plan[: plan.index("Generate")]


def test_the_stored_trend_has_no_customers(bank):
    assert "Aggregate" not in plan_of(bank.trend)
    assert bank.trend.count() > 10 and rows_of(bank.trend) == rows_of(trends.daily_trend(bank.build_days()))


def test_bitmaps_are_built_where_all_their_customers_meet(bank):
    plan = plan_of(bank.bitmaps)
    built = trends.active_bitmaps(bank.bank_facts, bank.card_facts, bank.accounts, bank.cards, bank.numbers)
    assert rows_of(bank.bitmaps) == rows_of(built) and "Aggregate" not in plan
    plan = plan_of(built)
    whole, partial = plan.index("functions=[bitmap_construct_agg"), plan.index("functions=[partial_bitmap_construct_agg")
    assert whole < partial and "Exchange" not in plan[whole:partial]


def test_a_full_load_of_bronze_is_not_shuffled(spark, lake):
    source = next(t for t in SOURCE_TABLES if t.bronze == "oracle_bank_accounts")
    rows = spark.createDataFrame([sb.account(f"A{i}", "C1") for i in range(40)], sb.source_schema(source.bronze))
    first = lambda *_: rows.repartition(5).select("*")
    assert ingest.run_ingest(lake, first, R1, "b1", [source], full=True) == {source.bronze: 40}
    stored = ingest.bronze_table(lake, source.bronze)
    assert stored.read().count() == 40 and len(list(Path(stored.path).glob("data/*/*/*.parquet"))) == 5


def test_a_delivery_is_stored_only_if_it_is_looked_at_again(spark, lake, monkeypatch):
    stored, write = [], conform.materialise
    monkeypatch.setattr(conform, "materialise", lambda df, label: stored.append(label) or write(df, label))
    ingest.run_ingest(lake, sb.reader(spark, sb.first_delivery()), R1, "b1")
    first = conform.run_conform(lake, R1, "b1", SILVER_TABLES)
    assert first["fct_bank_transactions"] > 0 and stored == []
    again = conform.run_conform(lake, R1 + timedelta(days=1), "b2", [t for t in SILVER_TABLES if t.kind == "fact"], everything=True)
    assert set(again.values()) == {0} and stored == ["delivered"] * 2
