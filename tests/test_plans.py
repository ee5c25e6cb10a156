"""Aggregates and plan shapes: edges of the window, hot keys, and where data is shuffled."""

import random
from datetime import date, timedelta

import pytest
import smallbank as sb
from helpers import rows_of
from pyspark.sql import functions as F

from clientlens.config import GoldSettings
from clientlens.plans import checks, export, mart, slices, trends
from clientlens.plans.activity import customer_activity, latest_transaction_date
from clientlens.plans.holdings import customer_holdings

AS_OF = date(2024, 10, 31)


def _frame(spark, bronze, rows):
    return spark.createDataFrame(rows, sb.source_schema(bronze)).coalesce(2)


def _activity(spark, bank, cards_txn, as_of=AS_OF, **settings):
    accounts = _frame(spark, "oracle_bank_accounts", [sb.account("A1", "C1"), sb.account("A2", "C1")])
    cards = _frame(spark, "pg_card_accounts", [sb.card("K1", "C1"), sb.card("K2", "C2")])
    return customer_activity(
        _frame(spark, "oracle_bank_transactions", bank),
        _frame(spark, "pg_card_transactions", cards_txn),
        accounts,
        cards,
        as_of,
        GoldSettings(**settings),
    )


def test_activity_matches_brute_force_with_a_hot_account(spark):
    rng = random.Random(7)
    days = [AS_OF - timedelta(days=d) for d in range(0, 800)]
    bank = [
        sb.bank_txn(f"B{i}", "A1" if i % 3 else "A2", rng.choice(days), round(rng.random() * 99, 2))
        for i in range(600)
    ]
    card = [
        sb.card_txn(f"T{i}", rng.choice(["K1", "K2"]), rng.choice(days), 1.25, rng.choice("XYZ"))
        for i in range(300)
    ]
    for lookback in (12, 24):
        got = _activity(spark, bank, card, lookback_months=lookback)
        low = date(2024 - lookback // 12, 10, 31)
        rows = [("C1", r[2], r[5], None, r[7]) for r in bank]
        owner = {"K1": "C1", "K2": "C2"}
        rows += [(owner[r[1]], r[2], r[4], r[8], r[9]) for r in card]
        for result in got.collect():
            mine = [r for r in rows if r[0] == result["customer_id"] and low < r[1] <= AS_OF]
            assert result["txn_count_12m"] == len(mine)
            assert round(sum(r[2] for r in mine), 2) == result["txn_amount_12m"]
            assert result["active_months_12m"] == len({(r[1].year, r[1].month) for r in mine})
            assert result["last_txn_date"] == max(r[1] for r in mine)
            assert result["digital_txn_ratio"] == sum(r[4] == "ONLINE" for r in mine) / len(mine)
            spent = {}
            for r in mine:
                if r[3]:
                    spent[r[3]] = spent.get(r[3], 0) + r[2]
            assert result["top_spend_category"] == min(spent, key=lambda c: (-spent[c], c))


def test_mid_month_window_can_touch_thirteen_months(spark):
    as_of = date(2024, 10, 15)
    bank = [sb.bank_txn(f"B{m}", "A1", date(2023 + m // 12, m % 12 + 1, 15), 1.0) for m in range(9, 22)]
    bank.append(sb.bank_txn("B0", "A1", date(2023, 10, 16), 1.0))
    bank.append(sb.bank_txn("BF", "A1", date(2024, 10, 16), 1.0))
    row = _activity(spark, bank, [], as_of).first()
    assert row["active_months_12m"] == 13 and row["txn_count_12m"] == 13


def test_long_windows_count_months_exactly(spark):
    bank = [
        sb.bank_txn(f"B{i}", "A1", date(2010 + i // 12, i % 12 + 1, 5), 1.0) for i in range(14 * 12)
    ]
    row = _activity(spark, bank, [], lookback_months=180).first()
    assert row["active_months_12m"] == 168


def test_loan_only_and_late_opened_customers(spark):
    customers = spark.createDataFrame(
        [("C1", True), ("C2", True), ("C3", False)], "customer_id string, is_current boolean"
    )
    late = date(2025, 1, 1)
    got = customer_holdings(
        customers,
        _frame(spark, "oracle_bank_accounts", [sb.account("A1", "C2", opened_date=late)]),
        _frame(spark, "pg_card_accounts", [sb.card("K", "C2", opened_date=late, limit=0.0)]),
        _frame(spark, "oracle_loans", [sb.loan("L", "C1", 5.0, "OVERDUE", maturity_date=None)]),
        AS_OF,
    )
    rows = {r["customer_id"]: r for r in got.collect()}
    assert sorted(rows) == ["C1", "C2"]
    assert rows["C1"]["first_open_date"] == AS_OF and rows["C1"]["days_past_due"] == 0
    assert rows["C1"]["has_npl_loan"] and rows["C1"]["net_asset_value"] == -5.0
    assert rows["C2"]["first_open_date"] == late and rows["C2"]["credit_utilization_rate"] == 0.0


def test_as_of_needs_transactions(spark):
    empty = _frame(spark, "oracle_bank_transactions", []).select("txn_date")
    with pytest.raises(ValueError, match="no transactions"):
        latest_transaction_date(empty, empty)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_has_no_single_task_stage(spark):
    from clientlens.catalogue import open_bank

    bank = open_bank(spark, "/root/testdata/sf0.001")
    for frame in (bank.base(mart_day()), bank.build_days(), bank.build_mart(mart_day())):
        assert "SinglePartition" not in _plan(frame)
        assert "CartesianProduct" not in _plan(frame)
        assert "BroadcastNestedLoopJoin" not in _plan(frame)


def mart_day():
    from clientlens.catalogue import AS_OF as day

    return day


def test_facts_are_scanned_once_and_reduced_before_the_join(spark):
    from clientlens.catalogue import open_bank

    plan = _plan(open_bank(spark, "/root/testdata/sf0.001").activity(mart_day()))
    assert plan.count("lineitem.parquet") == 1
    join = max(plan.rfind("Join ["), plan.rfind("HashJoin"))
    assert plan.index("partial_bit_or") < plan.index("lineitem.parquet") and join >= 0


def test_partitions_of_a_hot_account_are_split(spark):
    hot = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in hot}
    facts = (
        spark.range(0, 30000, 1, 8)
        .selectExpr(
            "concat('A', CASE WHEN id % 3 = 0 THEN 0 ELSE id % 500 END) AS account_id",
            "date_add(DATE '2024-01-01', CAST(id % 90 AS INT)) AS txn_date",
            "CAST(id % 100 AS DOUBLE) AS amount",
            "'POS' AS channel",
            "'COMPLETED' AS status",
            "'X' AS merchant_category",
        )
    )
    accounts = spark.range(500).selectExpr("concat('A', id) AS account_id", "concat('C', id % 50) AS customer_id")
    customers = spark.range(50).selectExpr("concat('C', id) AS customer_id", "'MASS' AS customer_segment", "true AS is_current")
    try:
        for k, v in hot.items():
            spark.conf.set(k, v)
        days = trends.customer_days(facts, facts, accounts, accounts, customers)
        trend = trends.daily_trend(days)
        rows = trend.collect()
        plan = _plan(trend)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["txn_count"] for r in rows) == 60000
    assert "skew=true" in plan


def test_window_filter_prunes_fact_partitions(spark, tmp_path):
    facts = _frame(
        spark,
        "oracle_bank_transactions",
        [sb.bank_txn("B1", "A1", AS_OF, 1.0), sb.bank_txn("B2", "A1", date(2001, 1, 1), 1.0)],
    )
    facts.write.partitionBy("txn_date").parquet(str(tmp_path / "facts"))
    stored = spark.read.schema(facts.schema).parquet(str(tmp_path / "facts"))
    accounts = _frame(spark, "oracle_bank_accounts", [sb.account("A1", "C1")])
    cards = _frame(spark, "pg_card_accounts", [])
    empty = _frame(spark, "pg_card_transactions", [])
    plan = _plan(customer_activity(stored, empty, accounts, cards, AS_OF, GoldSettings()))
    filters = plan[plan.index("PartitionFilters") :].splitlines()[0]
    assert "txn_date" in filters and "2023-10-31" in filters
    assert "ReadSchema: struct<account_id:string,amount:double,channel:string,status:string>" in plan


def test_table_counts_report_unreadable_tables(spark):
    counts = checks.table_counts(
        spark,
        {"good": lambda: spark.range(3), "bad": lambda: spark.read.parquet("/tmp/no-such-folder")},
    )
    rows = {r["table_name"]: r for r in counts.collect()}
    assert rows["good"]["n"] == 3 and rows["good"]["error"] is None
    assert rows["bad"]["n"] is None and "PATH_NOT_FOUND" in rows["bad"]["error"]


def test_export_writes_reports_and_metadata(spark, tmp_path):
    from clientlens.catalogue import open_bank

    bank = open_bank(spark, "/root/testdata/sf0.001")
    meta = export.export_reports(bank.snapshots, bank.days, str(tmp_path / "out")).first()
    assert meta["snapshots"] == ["2000-05-31", "2000-06-30"] and meta["row_count"] == 150
    assert meta["months"] == sorted(meta["months"]) and len(meta["columns"]) == 39
    files = list((tmp_path / "out" / "daily_trend").glob("*.zstd.parquet"))
    assert files
    monthly = spark.read.parquet(str(tmp_path / "out" / "monthly_active"))
    assert rows_of(monthly) == rows_of(trends.active_customers(bank.days, "month"))


def test_slice_filters_combine(spark):
    rows = [(date(2024, 1, 31), "MASS", 1), (date(2024, 2, 29), "MASS", 2), (date(2024, 2, 29), "X", 3)]
    df = spark.createDataFrame(rows, "snapshot_date date, customer_segment string, v int")
    assert rows_of(slices.mart_slice(df).select("v")) == [(2,), (3,)]
    assert rows_of(slices.mart_slice(df, segment="MASS").select("v")) == [(2,)]
    picked = slices.mart_slice(df, date(2024, 1, 31), where=F.col("v") > 1)
    assert picked.count() == 0


def test_mart_columns_hold_no_raw_identity():
    assert not {"phone", "email", "id_number"} & set(mart.MART_COLUMNS)
    assert len(mart.MART_COLUMNS) == 41
