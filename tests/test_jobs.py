"""End-to-end runs: bronze, silver, gold, repeated and changed deliveries, failures, upkeep."""

import re
import shutil
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
import smallbank as sb
from helpers import day, rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType

from clientlens.config import SILVER_TABLES, SOURCE_TABLES, GoldSettings, SourceTable
from clientlens.jobs.audit import AuditLog, JobFailed
from clientlens.jobs.conform import load_fact, load_scd2, new_batches, run_conform, silver_table
from clientlens.jobs.gold import build_mart, gold_table, resolve_as_of, run_gold
from clientlens.jobs.ingest import bronze_current, bronze_table, run_ingest
from clientlens.jobs.maintain import compact_tables, remask_snapshots
from clientlens.sources.lake import Lake, LakeTable
from clientlens.sources.scratch import materialise

R1 = datetime(2024, 11, 1, tzinfo=timezone.utc)
R2, R3 = R1 + timedelta(days=1), R1 + timedelta(days=2)
CUSTOMERS = next(t for t in SOURCE_TABLES if t.bronze == "pg_customers")
SILVER = {t.name: t for t in SILVER_TABLES}
SETTINGS = GoldSettings(
    cross_sell={
        "cross_sell_loan_flag": "NOT has_loan AND total_deposit_balance >= 1000",
        "cross_sell_card_flag": "NOT has_credit_card AND txn_count_12m >= 1",
        "cross_sell_invest_flag": "net_asset_value >= 5000 AND customer_segment IN ('PREMIER')",
    }
)


@pytest.fixture(scope="module")
def template(spark, tmp_path_factory):
    """A lake after the first delivery, built once and copied for every test."""
    root = tmp_path_factory.mktemp("template") / "lake"
    lake = Lake(spark, str(root))
    run_ingest(lake, sb.reader(spark, sb.first_delivery()), R1, "b1")
    run_conform(lake, R1, "b1")
    return root


@pytest.fixture
def loaded(lake, template):
    shutil.copytree(template, lake.root)
    return lake


def test_full_snapshot_twice_changes_nothing(spark, lake):
    read = sb.reader(spark, sb.first_delivery())
    first = run_ingest(lake, read, R1, "b1")
    second = run_ingest(lake, read, R2, "b2", full=True)
    assert first == second
    assert bronze_table(lake, "pg_customers").read().count() == 4


def test_increment_adds_and_replaces(spark, loaded):
    delivery = sb.first_delivery()
    changed = R1.replace(tzinfo=None) + timedelta(hours=1)
    delivery["pg_customers"] += [
        sb.customer("C005", "New One", updated_at=changed),
        sb.customer("C006", "No Time", updated_at=None),
    ]
    delivery["pg_customers"][1] = sb.customer("C002", "Do Van Khoa", "PREMIER", updated_at=changed)
    tables = [t for t in SOURCE_TABLES if t.source == "postgres"]
    written = run_ingest(loaded, sb.reader(spark, delivery), R2, "b2", tables)
    assert written["pg_customers"] == 2 and written["pg_card_accounts"] == 0
    current = bronze_current(loaded, CUSTOMERS)
    assert rows_of(current.select("customer_id", "_batch_id")) == [
        ("C001", "b1"),
        ("C002", "b2"),
        ("C003", "b1"),
        ("C004", "b1"),
        ("C005", "b2"),
    ]
    # A rerun of the same batch replaces its own rows.
    bronze = bronze_table(loaded, "pg_customers")
    again = materialise(bronze.read().filter("_batch_id = 'b2'"), "again")
    assert bronze.overwrite_partitions(again) == 2
    assert bronze.read().count() == 6


def test_full_snapshot_forgets_vanished_rows(spark, lake):
    delivery = sb.first_delivery()
    source = next(t for t in SOURCE_TABLES if t.bronze == "oracle_bank_accounts")
    run_ingest(lake, sb.reader(spark, delivery), R1, "b1", [source])
    delivery["oracle_bank_accounts"] = delivery["oracle_bank_accounts"][1:]
    run_ingest(lake, sb.reader(spark, delivery), R2, "b2", [source], full=True)
    assert bronze_table(lake, "oracle_bank_accounts").read().count() == 3


def test_failed_table_is_audited_and_raised_at_the_end(spark, lake):
    delivery = sb.first_delivery()
    del delivery["oracle_loans"]
    with pytest.raises(JobFailed) as failure:
        run_ingest(lake, sb.reader(spark, delivery), R1, "b1")
    assert list(failure.value.failures) == ["oracle_loans"]
    log = AuditLog(lake, "bronze")
    assert rows_of(log.read().groupBy("status").count()) == [("FAILED", 1), ("SUCCESS", 7)]
    assert log.last_run_time("oracle_loans") is None
    assert log.last_run_time("pg_customers") == R1


def test_silver_is_cleansed(loaded):
    customers = silver_table(loaded, SILVER["dim_customer"]).read()
    got = rows_of(customers.select("customer_id", "full_name", "city", "customer_segment"))
    assert got[0] == ("C001", "Mai Thu Lan", "Hue", "AFFLUENT")
    assert got[2] == ("C003", "Vo Ngoc", None, "PREMIER")
    accounts = silver_table(loaded, SILVER["dim_account"]).read()
    assert accounts.filter("status = 'CLOSED'").count() == 1
    facts = silver_table(loaded, SILVER["fct_bank_transactions"]).read()
    assert rows_of(facts.select("txn_id", "channel"))[1] == ("B2", "ATM")
    assert facts.count() == 5


def test_silver_twice_is_idempotent(loaded):
    again = run_conform(loaded, R2, "b2")
    assert again["dim_customer"] == 0
    assert again["fct_bank_transactions"] == 0 and again["fct_card_transactions"] == 0
    assert silver_table(loaded, SILVER["dim_customer"]).read().count() == 4
    assert silver_table(loaded, SILVER["dim_account"]).read().count() == 4
    assert silver_table(loaded, SILVER["dim_customer"]).published()["batch_id"] == "b1"


def test_segment_change_opens_a_version(spark, loaded):
    delivery = sb.first_delivery()
    changed = R1.replace(tzinfo=None) + timedelta(hours=1)
    delivery["pg_customers"] = [
        sb.customer("C002", "Do Van Khoa", "PREMIER", updated_at=changed),
        sb.customer("C004", "Renamed Only", updated_at=changed),
    ]
    run_ingest(loaded, sb.reader(spark, delivery), R2, "b2", [CUSTOMERS])
    assert new_batches(loaded, SILVER["dim_customer"]) == (["b2"], R2)
    changed = run_conform(loaded, R2, "b2", [SILVER["dim_customer"]])
    assert changed == {"dim_customer": 1}
    assert new_batches(loaded, SILVER["dim_customer"]) == ([], R2)
    # A retry with the same run time and batch changes nothing.
    assert run_conform(loaded, R2, "b2", [SILVER["dim_customer"]], only_batch="b2") == {"dim_customer": 1}
    table = silver_table(loaded, SILVER["dim_customer"]).read()
    versions = table.filter("customer_id = 'C002'").select(
        "version", "is_current", "customer_segment", "effective_to"
    )
    assert rows_of(versions) == [
        (1, False, "MASS", R2.replace(tzinfo=None)),
        (2, True, "PREMIER", None),
    ]
    assert table.filter("customer_id = 'C004'").first()["full_name"] == "Bui Ha"
    with pytest.raises(JobFailed, match="not after"):
        run_conform(loaded, R1, "b3", [SILVER["dim_customer"]])
    # Attributes alone, once asked for; what the earlier run closed is in the archive then.
    refreshed = run_conform(
        loaded, R3, "b3", [SILVER["dim_customer"]], everything=True, refresh_attributes=True
    )
    assert refreshed == {"dim_customer": 0}
    dimension = silver_table(loaded, SILVER["dim_customer"])
    assert dimension.read().filter("customer_id = 'C004'").first()["full_name"] == "Renamed Only"
    assert dimension.archive.read().count() == 1 and dimension.read().count() == 5
    assert rows_of(dimension.read().filter("customer_id = 'C002'").select(*versions.columns)) == rows_of(versions)


def test_crash_between_archive_and_publish(spark, loaded, monkeypatch):
    """Closed versions are seen once at every point of a run that dies, and after its retry."""
    table = SILVER["dim_customer"]
    for run, segment in ((R2, "PREMIER"), (R3, "AFFLUENT")):
        changed = run.replace(tzinfo=None) - timedelta(hours=1)
        delivery = {**sb.first_delivery(), "pg_customers": [sb.customer("C002", "Do Van Khoa", segment, updated_at=changed)]}
        run_ingest(loaded, sb.reader(spark, delivery), run, str(run), [CUSTOMERS])
        if run == R2:
            run_conform(loaded, R2, "s2", [table])
    dimension = silver_table(loaded, table)
    before = rows_of(dimension.read())

    def crash(*_, **__):
        raise OSError("lost driver")

    monkeypatch.setattr(LakeTable, "publish", crash)
    with pytest.raises(OSError):
        load_scd2(loaded, table, R3, "s3", [str(R3)])
    monkeypatch.undo()
    assert rows_of(dimension.read()) == before
    assert load_scd2(loaded, table, R3, "s3", [str(R3)]) == 1
    versions = dimension.read().filter("customer_id = 'C002'").select("version", "is_current", "customer_segment")
    assert rows_of(versions) == [(1, False, "MASS"), (2, False, "PREMIER"), (3, True, "AFFLUENT")]


def test_fact_modes(spark, loaded):
    delivery = sb.first_delivery()
    changed = R1.replace(tzinfo=None) + timedelta(hours=1)
    delivery["oracle_bank_transactions"] = [
        sb.bank_txn("B3", "A4", day("2024-08-01"), 30.0, created_at=changed),
        sb.bank_txn("B7", "A4", day("2024-10-31"), 70.0, created_at=changed),
    ]
    source = next(t for t in SOURCE_TABLES if t.bronze == "oracle_bank_transactions")
    run_ingest(loaded, sb.reader(spark, delivery), R2, "b2", [source])
    table = SILVER["fct_bank_transactions"]
    assert load_fact(loaded, table, R2, "b2", ["b2"], stable_dates=True) == 1
    assert load_fact(loaded, table, R2, "b2", ["b2"], stable_dates=True) == 0
    stored = silver_table(loaded, table)
    assert stored.read().filter("txn_id = 'B3'").first()["status"] == "PENDING"
    load_fact(loaded, table, R2, "b2", ["b2"], update=True)
    assert stored.read().filter("txn_id = 'B3'").first()["status"] == "COMPLETED"
    assert rows_of(stored.read().select("txn_id")) == [
        (f"B{i}",) for i in (1, 2, 3, 4, 5, 7)
    ]


def test_facts_without_a_date(spark, loaded):
    """NULL dates are one partition: kept by other loads, found again, moved by an update."""
    table = SILVER["fct_bank_transactions"]
    source = next(t for t in SOURCE_TABLES if t.bronze == "oracle_bank_transactions")
    stored = silver_table(loaded, table)

    def deliver(batch, run, *rows):
        changed = run.replace(tzinfo=None) - timedelta(hours=1)
        delivery = {**sb.first_delivery(), "oracle_bank_transactions": [sb.bank_txn(*r, created_at=changed) for r in rows]}
        run_ingest(loaded, sb.reader(spark, delivery), run, batch, [source])

    deliver("n1", R2, ("N1", "A4", None, 1.0), ("N2", "A4", None, 2.0))
    assert load_fact(loaded, table, R2, "n1", ["n1"], stable_dates=True) == 2
    assert load_fact(loaded, table, R2, "n1", ["n1"], stable_dates=True) == 0
    deliver("n2", R3, ("N1", "A4", day("2024-10-30"), 3.0), ("B3", "A4", None, 4.0))
    load_fact(loaded, table, R3, "n2", ["n2"], update=True)
    got = rows_of(stored.read().select("txn_id", "txn_date", "amount").filter("txn_id IN ('N1', 'N2', 'B3')"), "txn_id")
    assert got == [("B3", None, 4.0), ("N1", day("2024-10-30"), 3.0), ("N2", None, 2.0)]
    assert stored.read().count() == 7


def test_gold_values(loaded):
    assert resolve_as_of(loaded, SETTINGS) == day("2024-10-31")
    run_gold(loaded, R1, "g1", SETTINGS)
    mart = gold_table(loaded, "mart_customer_360").read()
    got = {r["customer_id"]: r.asDict() for r in mart.collect()}
    assert sorted(got) == ["C001", "C002", "C003", "C004"]

    lan = got["C001"]
    assert lan["full_name"] == "Mai ****" and lan["phone_masked"] == "090****001"
    assert lan["email_masked"] == "c***@mail.test" and lan["age"] == 44
    assert lan["total_product_count"] == 3 and lan["total_deposit_balance"] == 2000.0
    assert lan["has_savings"] and lan["has_current"] and lan["has_credit_card"]
    assert lan["credit_utilization_rate"] == 0.25 and lan["net_asset_value"] == 1750.0
    # Inside the window: B1, T1, T2 and T3 one day after its edge; equal categories go by name.
    assert lan["txn_count_12m"] == 4 and lan["txn_amount_12m"] == 22.5
    assert lan["active_months_12m"] == 2 and lan["top_spend_category"] == "BOOKS"
    assert lan["digital_txn_ratio"] == 0.5 and lan["recency_days"] == 0
    assert lan["avg_monthly_spend"] == 22.5 / 12 and lan["tenure_days"] == 1765
    assert lan["cross_sell_loan_flag"] and not lan["cross_sell_card_flag"]

    khoa = got["C002"]  # the closed account still counts for transactions, not for products
    assert khoa["txn_count_12m"] == 1 and khoa["total_product_count"] == 2
    assert not khoa["has_credit_card"] and khoa["has_npl_loan"] and khoa["days_past_due"] == 11
    assert khoa["cross_sell_card_flag"]

    ngoc = got["C003"]  # exactly one year back is outside; an unrated loan is not bad
    assert ngoc["txn_count_12m"] == 0 and ngoc["recency_days"] is None
    assert ngoc["has_loan"] and not ngoc["has_npl_loan"] and ngoc["cross_sell_invest_flag"]
    assert got["C004"]["total_product_count"] == 0 and got["C004"]["tenure_days"] == 0


def test_gold_snapshots_accumulate_and_rerun_replaces(loaded):
    run_gold(loaded, R1, "g1", SETTINGS)
    table = gold_table(loaded, "mart_customer_360")
    first = rows_of(table.read().drop("_gold_loaded_at", "_gold_batch_id"))
    run_gold(loaded, R2, "g2", SETTINGS)
    assert rows_of(table.read().drop("_gold_loaded_at", "_gold_batch_id")) == first
    build_mart(loaded, day("2024-11-01"), R2, "g3", SETTINGS)
    assert rows_of(table.read().groupBy("snapshot_date").count()) == [
        (day("2024-10-31"), 4),
        (day("2024-11-01"), 4),
    ]


def test_failed_gold_step_stops_and_leaves_no_trace(loaded):
    run_gold(loaded, R1, "g1", SETTINGS)
    table = gold_table(loaded, "mart_customer_360")
    before = rows_of(table.read())
    broken = GoldSettings(cross_sell={"cross_sell_loan_flag": "total_deposit_balance + 1"})
    with pytest.raises(ValueError, match="not a condition"):
        run_gold(loaded, R2, "g2", broken)
    assert rows_of(table.read()) == before
    assert AuditLog(loaded, "gold").read().filter("status = 'FAILED'").count() == 1


def test_remask_touches_only_leaky_snapshots(loaded):
    run_gold(loaded, R1, "g1", SETTINGS)
    table = gold_table(loaded, "mart_customer_360")
    raw = (
        table.read()
        .withColumn("full_name", F.lit("Mai Thu Lan"))
        .withColumn("snapshot_date", F.lit(day("2024-09-30")))
    )
    table.overwrite_partitions(materialise(raw, "raw"))
    assert remask_snapshots(table) == 4
    names = table.read().filter("snapshot_date = '2024-09-30'").select("full_name").distinct()
    assert rows_of(names) == [("Mai ****",)]
    stored = [p.read_bytes() for p in Path(loaded.root, "gold", "mart_customer_360").rglob("*.parquet")]
    assert len(stored) >= 2 and not any(b"Mai Thu Lan" in data for data in stored)
    assert remask_snapshots(table) == 0


DAYS = StructType().add("k", StringType()).add("day", DateType())


def test_other_partitions_stay_and_null_is_one(spark, lake):
    table = lake.table("gold", "days", DAYS, "day")
    table.replace(spark.createDataFrame([("a", day("2024-01-01")), ("b", None), ("c", day("2024-01-02"))], DAYS))
    table.overwrite_partitions(spark.createDataFrame([("a2", day("2024-01-01"))], DAYS))
    assert rows_of(table.read().select("k")) == [("a2",), ("b",), ("c",)]
    table.overwrite_partitions(spark.createDataFrame([("b2", None)], DAYS))
    assert rows_of(table.read().select("k")) == [("a2",), ("b2",), ("c",)]


def test_two_writers_do_not_touch_each_other(spark, lake):
    one, other = (lake.table("gold", "days", DAYS, "day") for _ in range(2))
    first, _ = one.draft(spark.createDataFrame([("one", day("2024-01-01"))], DAYS))
    second, _ = other.draft(spark.createDataFrame([("other", day("2024-01-01"))], DAYS))
    one.publish(first)
    assert rows_of(other.read().select("k")) == [("one",)]
    other.publish(second)
    assert rows_of(one.read().select("k")) == [("other",)]
    assert one._rows(first).count() == 1


def test_read_plan_does_not_grow_with_snapshots(spark, lake):
    table = lake.table("gold", "days", DAYS, "day")
    table.replace(spark.createDataFrame([("x", day("2024-01-01"))], DAYS))
    plan = lambda: table.read()._jdf.queryExecution().optimizedPlan().toString()
    before = plan()
    many = spark.range(1000).selectExpr("'y' AS k", "date_add(DATE'2020-01-01', int(id)) AS day")
    table.overwrite_partitions(many)
    shape = lambda text: re.sub(r"#\d+", "", text)
    assert table.read().count() == 1001 and shape(plan()) == shape(before)


def test_a_table_that_was_never_loaded(lake):
    table = lake.table("gold", "days", DAYS, "day")
    assert not table.exists() and table.state().count() == 0
    with pytest.raises(ValueError, match="never loaded"):
        table.read()


def test_compaction_keeps_content_and_survives_failures(loaded, lake):
    facts = silver_table(loaded, SILVER["fct_bank_transactions"])
    before = rows_of(facts.read())

    class Broken:
        def compact(self):
            raise OSError("no disk")

    summary = compact_tables({"broken": Broken(), "facts": facts})
    assert isinstance(summary["broken"], OSError) and summary["facts"] == 0
    for i in range(6):  # six files for one month, which has no others
        facts.append(facts.read().limit(1).withColumn("txn_id", F.lit(f"X{i}")).withColumn("txn_date", F.lit(day("2023-01-02"))).coalesce(1))
    before = rows_of(facts.read())
    assert compact_tables({"facts": facts}) == {"facts": 6}
    assert rows_of(facts.read()) == before
    left = facts.read().filter("txn_date = '2023-01-02'").select("_metadata.file_path").distinct()
    assert left.count() == 1


def test_crash_before_publish_is_invisible_and_retry_converges(spark, lake, monkeypatch):
    schema = sb.source_schema("oracle_products")
    table = lake.table("silver", "products", schema)
    table.replace(spark.createDataFrame([sb.product("P1")], schema))
    next_state = spark.createDataFrame([sb.product("P1"), sb.product("P2")], schema)

    def crash(*_, **__):
        raise OSError("lost driver")

    monkeypatch.setattr(type(table), "publish", crash)
    with pytest.raises(OSError):
        table.replace(next_state)
    monkeypatch.undo()
    assert table.read().count() == 1
    assert table.replace(next_state) == 2
    assert table.read().count() == 2


def test_appends_and_overwrites_beside_a_compaction_stay(spark, lake, monkeypatch):
    table = lake.table("gold", "days", DAYS, "day")
    for i in range(6):
        table.append(spark.createDataFrame([(f"a{i}", day("2024-01-01")), (f"b{i}", day("2024-01-02"))], DAYS).coalesce(1))
    publish = LakeTable.publish

    def late(self, folder, *args, kind="full", **kwargs):
        if kind == "compact":
            monkeypatch.setattr(LakeTable, "publish", publish)
            other = lake.table("gold", "days", DAYS, "day")
            other.append(spark.createDataFrame([("late", day("2024-01-01"))], DAYS))
            other.overwrite_partitions(spark.createDataFrame([("new", day("2024-01-02"))], DAYS))
        publish(self, folder, *args, kind=kind, **kwargs)

    monkeypatch.setattr(LakeTable, "publish", late)
    assert table.compact() == 12
    assert rows_of(table.read().select("k")) == [*((f"a{i}",) for i in range(6)), ("late",), ("new",)]
    assert table.vacuum(datetime.now(timezone.utc) + timedelta(days=1)) > 0
    assert rows_of(table.read().select("k")) == [*((f"a{i}",) for i in range(6)), ("late",), ("new",)]


def test_a_crash_of_an_overwrite_leaves_the_partition(spark, lake, monkeypatch):
    table = lake.table("gold", "days", DAYS, "day")
    table.replace(spark.createDataFrame([("a", day("2024-01-01")), ("b", None)], DAYS))

    def crash(*_, **__):
        raise OSError("lost driver")

    monkeypatch.setattr(LakeTable, "publish", crash)
    with pytest.raises(OSError):
        table.overwrite_partitions(spark.createDataFrame([("c", day("2024-01-01"))], DAYS))
    monkeypatch.undo()
    assert rows_of(table.read().select("k")) == [("a",), ("b",)]
    # What never counted goes, what counts stays.
    assert table.vacuum(datetime.now(timezone.utc) - timedelta(hours=1)) == 0
    assert table.vacuum(datetime.now(timezone.utc) + timedelta(hours=1)) == 1
    assert rows_of(table.read().select("k")) == [("a",), ("b",)]


def test_unknown_table_needs_a_key():
    from clientlens.config import source_tables_from_mapping

    raw = {"sources": {"s": {"tables": [{"name": "x", "bronze_table": "bronze.s_x"}]}}}
    with pytest.raises(ValueError, match="no key"):
        source_tables_from_mapping(raw)
    raw["sources"]["s"]["tables"][0]["key"] = "id"
    assert source_tables_from_mapping(raw) == [SourceTable("s", "x", "s_x", "id", "updated_at")]


def test_command_line_jobs(spark, loaded, tmp_path, capsys):
    from clientlens import cli

    settings = tmp_path / "gold.yaml"
    settings.write_text("lookback_months: 6\n", encoding="utf-8")

    def run(job, *options):
        args = cli.parse([job, "--lake", loaded.root, "--batch", "x", *options])
        cli._JOBS[job](loaded, args)
        return capsys.readouterr().out

    assert "'mart_customer_360': 4" in run("gold", "--config", str(settings))
    report = run("verify", "--customer", "C001")
    assert "Mai ****" in report and "PATH_NOT_FOUND" not in report
    leaky = gold_table(loaded, "mart_customer_360")
    clean = materialise(leaky.read(), "clean")
    leaky.overwrite_partitions(clean.withColumn("full_name", F.lit("Mai Thu Lan")).limit(3))
    with pytest.raises(SystemExit, match="incomplete snapshots, leaks"):
        run("verify")
    capsys.readouterr()
    leaky.overwrite_partitions(clean)
    assert "2024-10-31" in run("export", "--out", str(tmp_path / "out"))
    assert run("remask").strip() == "0"
    assert "mart_customer_360 0" in run("compact")
    with pytest.raises(SystemExit):
        cli.parse(["ingest", "--lake", loaded.root])
