"""Every query and operator as a named callable over a folder of input tables.

The banking tables are derived from the bundled tables by :mod:`clientlens.adapters`. Amounts
there are small, so the cross-sell thresholds are set to match.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientlens import adapters
from clientlens.config import SILVER_TABLES, SOURCE_TABLES, UPPER_COLUMNS, GoldSettings, SilverTable
from clientlens.functions import masking, segments
from clientlens.functions.times import instant
from clientlens.jobs import conform as conform_job
from clientlens.jobs import gold, ingest
from clientlens.jobs.audit import AuditLog
from clientlens.operators import cleansing, compare, incremental, scd
from clientlens.plans import (
    activity,
    checks,
    dashboard,
    export,
    governance,
    holdings,
    lists,
    mart,
    measures,
    slices,
    trends,
)
from clientlens.schemas import BRONZE, GOLD, SILVER, align_to_schema
from clientlens.sources.lake import Lake
from clientlens.sources.scratch import materialise, scratch_root
from clientlens.streaming.ingest import ingest_files

AS_OF = date(2000, 6, 30)
PREVIOUS = date(2000, 5, 31)
FIRST_RUN = datetime(2000, 1, 1)
SECOND_RUN = datetime(2000, 2, 1)
BETWEEN_RUNS, AFTER_RUNS = datetime(2000, 1, 15), datetime(2000, 2, 15)
SETTINGS = GoldSettings(
    as_of=AS_OF,
    lookback_months=24,
    cross_sell={
        "cross_sell_loan_flag": "NOT has_loan AND total_deposit_balance >= 5000",
        "cross_sell_card_flag": "NOT has_credit_card AND txn_count_12m >= 3",
        "cross_sell_invest_flag": (
            "net_asset_value >= 8000 AND customer_segment IN ('AFFLUENT','PREMIER')"
        ),
    },
)
TABLES = {t.name: t for t in SILVER_TABLES}

FACTS_CUT = date(2000, 1, 1)

AUDIT_SQL = """
    SELECT concat('b', CAST(event_id AS STRING)) AS batch_id,
           event_type AS table_name,
           'events' AS source_system,
           CASE WHEN event_id % 3 = 0 THEN 'full_snapshot' ELSE 'incremental' END AS run_mode,
           CASE WHEN event_id % 5 = 0 OR event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
           CAST(floor(value) AS BIGINT) AS rows_ingested,
           CAST(ts AS TIMESTAMP) AS current_run_time
    FROM {events}
"""


class Bank:
    """The bank's tables over one input folder, each built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def source(self, name: str) -> DataFrame:
        return adapters.source_table(self.spark, self.folder, name)

    def _conformed(self, source: str, table: str) -> DataFrame:
        spec = TABLES[table]
        return cleansing.conform(self.source(source), [spec.key], UPPER_COLUMNS[spec.kind])

    @cached_property
    def customers(self) -> DataFrame:
        delivered = self._conformed("src_customers", "dim_customer")
        return delivered.withColumn("is_current", F.lit(True))

    @cached_property
    def changed_customers(self) -> DataFrame:
        second = adapters.changed_customers(self.spark, self.folder)
        return cleansing.conform(second, ["customer_id"], UPPER_COLUMNS["scd2"])

    @cached_property
    def accounts(self) -> DataFrame:
        return self._conformed("src_bank_accounts", "dim_account")

    @cached_property
    def cards(self) -> DataFrame:
        return self._conformed("src_card_accounts", "dim_card_account")

    @cached_property
    def loans(self) -> DataFrame:
        return self._conformed("src_loans", "dim_loan")

    @cached_property
    def bank_facts(self) -> DataFrame:
        return self._conformed("src_bank_transactions", "fct_bank_transactions")

    @cached_property
    def card_facts(self) -> DataFrame:
        return self._conformed("src_card_transactions", "fct_card_transactions")

    @cached_property
    def audit(self) -> DataFrame:
        events = adapters.load(self.spark, self.folder, "events")
        return self.spark.sql(AUDIT_SQL, events=events)

    def history(self, run_ts: datetime, deliveries: list[DataFrame]) -> DataFrame:
        """Customer dimension after the given deliveries, one month apart."""
        table = TABLES["dim_customer"]
        state = align_to_schema(self.spark.sql("SELECT 1 AS x WHERE false"), SILVER["dim_customer"])
        for i, delivered in enumerate(deliveries):
            run = datetime(run_ts.year, run_ts.month + i, 1)
            state = scd.scd2_apply(state, delivered, table, run, f"run{i + 1}")
        return state

    @cached_property
    def customer_history(self) -> DataFrame:
        return self.history(FIRST_RUN, [self.customers, self.changed_customers])

    @cache
    def job_lake(self, *bronze: str, silver_runs: int = 2, mart: bool = False) -> Lake:
        """A lake after the jobs ran over some of these tables, each silver run as often as asked for.

        ``run1`` delivers everything but the bank transactions from ``FACTS_CUT`` on, ``run1b`` all bank
        transactions, then gold is built; ``run2`` delivers the changed customers.
        """
        lake = Lake(self.spark, f"{scratch_root(self.spark)}/lake-{uuid.uuid4().hex}")
        first = {
            "pg_customers": lambda: self.source("src_customers"),
            "oracle_bank_accounts": lambda: self.source("src_bank_accounts"),
            "pg_card_accounts": lambda: self.source("src_card_accounts"),
            "oracle_loans": lambda: self.source("src_loans"),
            "oracle_bank_transactions": lambda: self.bank_facts.filter(F.col("txn_date") < FACTS_CUT),
            "pg_card_transactions": lambda: self.card_facts,
        }
        later = {"oracle_bank_transactions": lambda: self.bank_facts}
        changed = {"pg_customers": lambda: adapters.changed_customers(self.spark, self.folder)}
        for batch, run_ts, delivery in (
            ("run1", FIRST_RUN, first),
            ("run1b", BETWEEN_RUNS, later),
            ("run2", SECOND_RUN, changed),
        ):
            if mart and batch == "run2":
                break
            sources = [t for t in SOURCE_TABLES if t.bronze in delivery and (t.bronze in bronze or not bronze)]
            targets = [t for t in SILVER_TABLES if t.bronze in {s.bronze for s in sources}]
            read = lambda table, last, now, rows=delivery: rows[table.bronze]()
            ingest.run_ingest(lake, read, run_ts, batch, sources)
            for _ in range(silver_runs):
                conform_job.run_conform(lake, run_ts, batch, targets)
            if mart and batch == "run1b":
                gold.run_gold(lake, run_ts, batch, SETTINGS)
        return lake

    def job_table(self, name: str) -> DataFrame:
        table = TABLES[name]
        return conform_job.silver_table(self.job_lake(table.bronze), table).read()

    def holdings(self, as_of: date) -> DataFrame:
        return holdings.customer_holdings(
            self.customers, self.accounts, self.cards, self.loans, as_of
        )

    def activity(self, as_of: date, settings: GoldSettings = SETTINGS) -> DataFrame:
        return activity.customer_activity(
            self.bank_facts, self.card_facts, self.accounts, self.cards, as_of, settings
        )

    def base(self, as_of: date) -> DataFrame:
        return mart.mart_base(self.customers, self.holdings(as_of), self.activity(as_of), as_of)

    def build_mart(self, as_of: date) -> DataFrame:
        return mart.customer_mart(
            self.customers, self.holdings(as_of), self.activity(as_of), as_of, SETTINGS
        )

    def activities(self, *as_ofs: date) -> DataFrame:
        return activity.customer_activities(
            self.bank_facts, self.card_facts, self.accounts, self.cards, as_ofs, SETTINGS
        )

    @cached_property
    def stored_customers(self) -> DataFrame:
        return materialise(self.customers, "customers")

    @cached_property
    def snapshots(self) -> DataFrame:
        """Two mart snapshots, stored once by their date and shared by all report queries. One scan of
        the facts serves both, and one conformed copy of each dimension; of loans, those that count as
        holdings."""
        customers = self.stored_customers
        accounts, cards = materialise(self.accounts, "accounts"), materialise(self.cards, "cards")
        loans = materialise(holdings.active_products(self.loans), "loans")
        facts = self.bank_facts, self.card_facts
        active = activity.customer_activities(*facts, accounts, cards, (PREVIOUS, AS_OF), SETTINGS)
        active = materialise(active, "activities", "as_of")
        both = []
        for d in (PREVIOUS, AS_OF):
            held = holdings.customer_holdings(customers, accounts, cards, loans, d)
            both.append(mart.customer_mart(customers, held, active.filter(F.col("as_of") == d).drop("as_of"), d, SETTINGS))
        return materialise(both[0].unionByName(both[1]), "mart", "snapshot_date")

    @cached_property
    def snapshot(self) -> DataFrame:
        return slices.mart_slice(self.snapshots)

    @cached_property
    def days(self) -> DataFrame:
        """Customer days, stored once."""
        return materialise(self.build_days(), "days")

    def build_days(self) -> DataFrame:
        return trends.customer_days(
            self.bank_facts, self.card_facts, self.accounts, self.cards, self.customers
        )

    @cached_property
    def numbers(self) -> DataFrame:
        return trends.customer_numbers(self.customers)

    @cached_property
    def bitmaps(self) -> DataFrame:
        """Who was active on each day, stored once: all counts of active customers come from it."""
        built = trends.active_bitmaps(self.bank_facts, self.card_facts, self.accounts, self.cards, self.numbers)
        return materialise(built, "active")

    @cached_property
    def trend(self) -> DataFrame:
        """The daily trend, stored once and shared by all trend queries; customer days, nearly as many as
        the facts, are not."""
        return materialise(trends.daily_trend(self.build_days()), "trend")


_banks: dict[tuple[str, str], Bank] = {}


def open_bank(spark: SparkSession, folder: str) -> Bank:
    """The bank over a folder; its stored intermediates live as long as the application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _banks:
        _banks[key] = Bank(spark, folder)
    return _banks[key]


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Round averages of DOUBLE columns, whose last digits depend on the order of addition."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


QUERIES: dict[str, Callable[[Bank], DataFrame]] = {}


def query(build: Callable[[Bank], DataFrame]) -> Callable[[Bank], DataFrame]:
    QUERIES[build.__name__] = build
    return build


# --- ingest -----------------------------------------------------------------------------------


@query
def incremental_window(bank: Bank) -> DataFrame:
    events = adapters.load(bank.spark, bank.folder, "events")
    changed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return incremental.change_window(changed, "ts", datetime(2024, 1, 5), datetime(2024, 1, 20))


@query
def audit_watermark(bank: Bank) -> DataFrame:
    return incremental.watermarks(bank.audit)


@query
def bronze_metadata(bank: Bank) -> DataFrame:
    return incremental.with_ingest_meta(
        bank.source("src_bank_accounts"), FIRST_RUN, "oracle", "batch1"
    )


@query
def align_schema(bank: Bank) -> DataFrame:
    """Upper-case names, text amounts, a missing and an extra column onto the bronze schema."""
    shouting = bank.source("src_bank_accounts").select(
        F.col("account_id").alias("ACCOUNT_ID"),
        F.col("customer_id").alias("CUSTOMER_ID"),
        F.col("status").alias("STATUS"),
        F.col("opened_date").cast("string").alias("OPENED_DATE"),
        F.when(F.col("status") == "CLOSED", "n/a")
        .otherwise(F.col("balance").cast("string"))
        .alias("BALANCE"),
        F.lit("x").alias("NOT_IN_TARGET"),
    )
    stamped = incremental.with_ingest_meta(shouting, FIRST_RUN, "oracle", "batch1")
    return align_to_schema(stamped, BRONZE["oracle_bank_accounts"])


def _customer_batches(bank: Bank) -> DataFrame:
    first = incremental.with_ingest_meta(bank.source("src_customers"), FIRST_RUN, "postgres", "b1")
    second = incremental.with_ingest_meta(
        adapters.changed_customers(bank.spark, bank.folder), SECOND_RUN, "postgres", "b2"
    )
    return first.unionByName(second)


@query
def bronze_upsert(bank: Bank) -> DataFrame:
    return incremental.current_rows(_customer_batches(bank), "customer_id")


@query
def stream_once(bank: Bank) -> DataFrame:
    """Files that arrive in two runs of a stream; the second run gets all files of the first again."""
    root = f"{scratch_root(bank.spark)}/stream-{uuid.uuid4().hex}"
    first = bank.source("src_customers")
    second = adapters.changed_customers(bank.spark, bank.folder)
    target = Lake(bank.spark, root).table("bronze", "pg_customers", BRONZE["pg_customers"], "_batch_id")
    for delivered in (first, first.unionByName(second)):
        delivered.select(*first.columns).write.mode("append").parquet(f"{root}/in")
        run = ingest_files(target, f"{root}/in", first.schema, f"{root}/checkpoint", "postgres", once_within="30 days")
        run.awaitTermination()
    return target.read().select(*first.columns)


@query
def export_meta(bank: Bank) -> DataFrame:
    described = export.export_metadata(
        bank.snapshots.select(*export.EXPORT_COLUMNS), bank.trend
    )
    lists_ = ("snapshots", "months", "columns")
    return described.withColumns({c: F.array_join(c, ",") for c in lists_})


# --- cleansing --------------------------------------------------------------------------------


@query
def clean_strings(bank: Bank) -> DataFrame:
    return cleansing.clean_strings(bank.source("src_bank_transactions"))


@query
def upper_codes(bank: Bank) -> DataFrame:
    return cleansing.upper_columns(bank.source("src_bank_transactions"), UPPER_COLUMNS["fact"])


@query
def dedup_latest(bank: Bank) -> DataFrame:
    return cleansing.latest_per_key(
        bank.source("src_card_transactions"), ["txn_id"], ["_ingested_at"]
    )


@query
def drop_null_keys(bank: Bank) -> DataFrame:
    return cleansing.drop_null_keys(bank.source("src_bank_transactions"), ["txn_id"])


@query
def conformed_bank_transactions(bank: Bank) -> DataFrame:
    return bank.bank_facts


# --- dimensions and facts ---------------------------------------------------------------------


@query
def scd1_upsert(bank: Bank) -> DataFrame:
    stored = bank.customers.drop("is_current")
    return scd.scd1_merge(stored, bank.changed_customers, "customer_id")


@query
def scd2_row_hash(bank: Bank) -> DataFrame:
    tracked = TABLES["dim_customer"].tracked
    return bank.customers.select("customer_id", scd.row_hash(tracked).alias("row_hash"))


@query
def scd2_changes(bank: Bank) -> DataFrame:
    state = bank.history(FIRST_RUN, [bank.customers])
    changes = scd.scd2_changes(state, bank.changed_customers, TABLES["dim_customer"])
    return changes.select("customer_id", "customer_segment", "change", "old_version")


@query
def scd2_apply(bank: Bank) -> DataFrame:
    return bank.customer_history


@query
def scd2_refresh_attributes(bank: Bank) -> DataFrame:
    table: SilverTable = TABLES["dim_customer"]
    state = bank.history(FIRST_RUN, [bank.customers])
    return scd.scd2_apply(
        state, bank.changed_customers, table, SECOND_RUN, "run2", refresh_attributes=True
    )


@query
def scd2_history(bank: Bank) -> DataFrame:
    return scd.scd2_history(bank.customer_history, "customer_id", "CIF000000007").select(
        "customer_id",
        "customer_segment",
        "city",
        "version",
        "is_current",
        "effective_from",
        "effective_to",
    )


@query
def scd2_as_of(bank: Bank) -> DataFrame:
    valid = scd.scd2_as_of(bank.customer_history, datetime(2000, 1, 15))
    return valid.select("customer_id", "customer_segment", "version")


@query
def scd2_fact_segment(bank: Bank) -> DataFrame:
    """Bank transactions with the customer segment that was valid on their own day."""
    owned = bank.bank_facts.join(bank.accounts.select("account_id", "customer_id"), "account_id")
    facts = owned.select("txn_id", "customer_id", "txn_date", "amount")
    return scd.join_as_of(
        facts, bank.customer_history, "customer_id", "txn_date", ["customer_segment", "version"]
    )


@query
def fact_insert_new(bank: Bank) -> DataFrame:
    stored = bank.bank_facts.filter(F.col("txn_date") < date(2000, 1, 1))
    return scd.fact_new_rows(stored, bank.bank_facts, "txn_id")


# --- gold -------------------------------------------------------------------------------------


@query
def agg_holdings(bank: Bank) -> DataFrame:
    return bank.holdings(AS_OF)


@query
def agg_txn_12m(bank: Bank) -> DataFrame:
    return bank.activity(AS_OF)


@query
def agg_txn_auto(bank: Bank) -> DataFrame:
    """Default settings: 12 months up to the latest transaction."""
    narrow = ["account_id", "txn_date", "amount", "channel", "status"]
    bank_facts = materialise(bank.bank_facts.select(*narrow), "facts")
    card_facts = materialise(bank.card_facts.select(*narrow, "merchant_category"), "facts")
    as_of = activity.latest_transaction_date(bank_facts, card_facts)
    return activity.customer_activity(bank_facts, card_facts, bank.accounts, bank.cards, as_of, GoldSettings())


@query
def mart_base(bank: Bank) -> DataFrame:
    return bank.base(AS_OF).drop("full_name", "phone_masked", "email_masked")


@query
def mart_customer_360(bank: Bank) -> DataFrame:
    return bank.build_mart(AS_OF)


@query
def customer_age(bank: Bank) -> DataFrame:
    age = mart.age_in_years(AS_OF, F.col("date_of_birth"))
    return bank.source("src_customers").select("customer_id", "date_of_birth", age.alias("age"))


@query
def tenure(bank: Bank) -> DataFrame:
    return bank.holdings(AS_OF).select(
        "customer_id",
        "first_open_date",
        mart.tenure_days(AS_OF).alias("tenure_days"),
    )


@query
def rfm_scores(bank: Bank) -> DataFrame:
    return bank.snapshot.select("customer_id", "r_score", "f_score", "m_score", "rfm_score")


@query
def rfm_segment(bank: Bank) -> DataFrame:
    return bank.snapshot.select(
        "rfm_score",
        segments.rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score")).alias("segment"),
    ).distinct()


@query
def cross_sell_flags(bank: Bank) -> DataFrame:
    unflagged = bank.snapshot.drop(*SETTINGS.cross_sell)
    return segments.with_rules(unflagged, SETTINGS.cross_sell).select(
        "customer_id", *SETTINGS.cross_sell
    )


# --- masking and governance -------------------------------------------------------------------


@query
def mask_name(bank: Bank) -> DataFrame:
    masked = masking.mask_name(F.col("full_name"))
    return bank.source("src_customers").select("customer_id", masked.alias("masked"))


@query
def mask_phone(bank: Bank) -> DataFrame:
    masked = masking.mask_phone(F.col("phone"))
    return bank.source("src_customers").select("customer_id", masked.alias("masked"))


@query
def mask_email(bank: Bank) -> DataFrame:
    masked = masking.mask_email(F.col("email"))
    return bank.source("src_customers").select("customer_id", masked.alias("masked"))


@query
def hash_token(bank: Bank) -> DataFrame:
    token = masking.hash_token(F.col("id_number"))
    return bank.source("src_customers").select("customer_id", token.alias("token"))


def _leaky_mart(bank: Bank) -> DataFrame:
    """The mart as it was before masking: the previous snapshot shows full names."""
    names = bank.stored_customers.select("customer_id", F.col("full_name").alias("raw_name"))
    old = F.col("snapshot_date") == PREVIOUS
    return (
        bank.snapshots.join(names, "customer_id")
        .withColumn("full_name", F.when(old, F.col("raw_name")).otherwise(F.col("full_name")))
        .withColumn("email_masked", F.when(~old, F.col("email_masked")))
        .drop("raw_name")
    )


@query
def remask_partitions(bank: Bank) -> DataFrame:
    return governance.remask(_leaky_mart(bank)).select("customer_id", "snapshot_date", "full_name")


@query
def pii_leak_counts(bank: Bank) -> DataFrame:
    return checks.pii_leaks(_leaky_mart(bank))


@query
def pii_sample(bank: Bank) -> DataFrame:
    return checks.pii_sample(bank.snapshots)


@query
def pii_masked_by_snapshot(bank: Bank) -> DataFrame:
    return checks.masked_by_snapshot(_leaky_mart(bank))


@query
def snapshot_history(bank: Bank) -> DataFrame:
    """The stored snapshots, each the outcome of one overwrite of its partition, oldest first."""
    rows = bank.snapshots.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows"))
    nth = F.row_number().over(Window.orderBy("snapshot_date"))
    return rows.select(nth.alias("version"), F.lit("overwrite").alias("operation"), "rows")


@query
def snapshot_at_version(bank: Bank) -> DataFrame:
    """The mart as it was after its first snapshot."""
    first = bank.snapshots.filter(F.col("snapshot_date") <= PREVIOUS)
    return first.select(*mart.MART_COLUMNS)


@query
def snapshot_diff(bank: Bank) -> DataFrame:
    old = bank.snapshots.filter(F.col("snapshot_date") == PREVIOUS)
    columns = ["rfm_segment", "txn_count_12m", "top_spend_category"]
    return compare.compare_versions(old, bank.snapshot, "customer_id", columns, changed_only=True)


@query
def snapshot_key_changes(bank: Bank) -> DataFrame:
    columns = ["customer_segment", "email"]
    return compare.key_changes(bank.customers, bank.changed_customers, "customer_id", columns)


@query
def load_changes(bank: Bank) -> DataFrame:
    """What a second published load of the customers changed, by digests of key buckets."""
    table = Lake(bank.spark, f"{scratch_root(bank.spark)}/lake-{uuid.uuid4().hex}").table(
        "silver", "customers", bank.changed_customers.schema, "customer_segment"
    )
    first = bank.customers.drop("is_current")
    table.replace(first)
    # The second load takes the place of the first one in the segments that it has rows for.
    table.overwrite_partitions(bank.changed_customers)
    return compare.changes(*table.difference(1, 2), "customer_id", ["customer_segment", "email"])


# --- the jobs, over the same tables --------------------------------------------------------------


@query
def job_bronze_batches(bank: Bank) -> DataFrame:
    """Rows of each batch in bronze: a full load, and increments beside it."""
    names = ("pg_customers", "oracle_bank_transactions")
    lake = bank.job_lake(*names, silver_runs=0)
    rows = [ingest.bronze_table(lake, n).read().select(F.lit(n).alias("table_name"), "_batch_id") for n in names]
    both = rows[0].unionByName(rows[1])
    return both.groupBy("table_name", F.col("_batch_id").alias("batch_id")).agg(F.count(F.lit(1)).alias("n"))


@query
def job_audit(bank: Bank) -> DataFrame:
    log = AuditLog(bank.job_lake(silver_runs=0), "bronze").read()
    return log.select("table_name", "batch_id", "run_mode", "status", "rows_ingested")


@query
def job_dim_account(bank: Bank) -> DataFrame:
    return bank.job_table("dim_account").select("account_id", "customer_id", "status", "balance", "_silver_batch_id")


@query
def silver_scd2_rerun(bank: Bank) -> DataFrame:
    return bank.job_table("dim_customer").select(*scd.version_columns(TABLES["dim_customer"]))


@query
def silver_fact_rerun(bank: Bank) -> DataFrame:
    columns = ["txn_id", "account_id", "txn_date", "amount", "channel", "status"]
    return bank.job_table("fct_bank_transactions").select(*columns, "_silver_batch_id")


@query
def job_mart(bank: Bank) -> DataFrame:
    return gold.gold_table(bank.job_lake(silver_runs=1, mart=True), "mart_customer_360").read().select(*mart.MART_COLUMNS)


# --- verification -----------------------------------------------------------------------------


@query
def table_counts(bank: Bank) -> DataFrame:
    tables = {
        "dim_customer": lambda: bank.customers,
        "dim_account": lambda: bank.accounts,
        "dim_card_account": lambda: bank.cards,
        "dim_loan": lambda: bank.loans,
        "fct_bank_transactions": lambda: bank.bank_facts,
        "fct_card_transactions": lambda: bank.card_facts,
    }
    return checks.table_counts(bank.spark, tables)


@query
def audit_recent(bank: Bank) -> DataFrame:
    return checks.recent_audit(bank.audit)


@query
def customer_lookup(bank: Bank) -> DataFrame:
    return lists.customer_lookup(bank.snapshots, "CIF000000007").select(
        "customer_id", "snapshot_date", "full_name", "rfm_segment", "total_deposit_balance"
    )


@query
def mart_completeness(bank: Bank) -> DataFrame:
    """The first snapshot was loaded before the second delivery of customers, the second after it."""
    old = F.col("snapshot_date") == PREVIOUS
    loaded = F.when(old, instant(BETWEEN_RUNS)).otherwise(instant(AFTER_RUNS))
    return checks.mart_completeness(
        bank.snapshots.withColumn("_gold_loaded_at", loaded), bank.customer_history
    )


@query
def rfm_distribution(bank: Bank) -> DataFrame:
    return checks.rfm_distribution(bank.snapshot)


@query
def cross_sell_counts(bank: Bank) -> DataFrame:
    return checks.cross_sell_counts(bank.snapshot)


@query
def segment_net_asset(bank: Bank) -> DataFrame:
    return checks.segment_net_asset(bank.snapshot)


# --- lists and trends -------------------------------------------------------------------------


@query
def marketing_rfm(bank: Bank) -> DataFrame:
    return lists.marketing_list(bank.snapshot)


@query
def sales_crosssell(bank: Bank) -> DataFrame:
    return lists.sales_list(bank.snapshot)


@query
def latest_snapshot(bank: Bank) -> DataFrame:
    return slices.latest_snapshot(bank.snapshots).select("customer_id", "snapshot_date")


@query
def mart_slice_filtered(bank: Bank) -> DataFrame:
    return slices.mart_slice(
        bank.snapshots, PREVIOUS, "PREMIER", F.col("total_product_count") >= 2
    ).select("customer_id", "customer_segment", "total_product_count", "snapshot_date")


@query
def trend_slice_filtered(bank: Bank) -> DataFrame:
    return slices.trend_slice(bank.trend, "day", date(1999, 1, 1), date(1999, 6, 1), "MASS")


@query
def daily_trend(bank: Bank) -> DataFrame:
    return trends.daily_trend(bank.build_days())


@query
def monthly_active(bank: Bank) -> DataFrame:
    return trends.active_from_bitmaps(bank.bitmaps, "month")


@query
def daily_active(bank: Bank) -> DataFrame:
    return trends.active_from_bitmaps(bank.bitmaps, "day")


@query
def active_span(bank: Bank) -> DataFrame:
    """Distinct customers of all segments that were active in a quarter, from the daily bitmaps."""
    quarter = F.col("day").between(date(1999, 1, 1), date(1999, 3, 31))
    return trends.active_from_bitmaps(bank.bitmaps.filter(quarter), None, ())


def _late(facts: DataFrame) -> DataFrame:
    """The second delivery: each tenth transaction from ``FACTS_CUT`` on."""
    return facts.filter((F.col("txn_date") >= FACTS_CUT) & (F.crc32("txn_id") % 10 == 0))


def _refreshed(bank: Bank, rebuild: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Day partials of the first delivery, stored, brought up to date after the second one."""
    both = materialise(bank.bank_facts, "facts"), materialise(bank.card_facts, "facts")
    late = [_late(f) for f in both]
    stored = materialise(rebuild(*(f.join(x.select("txn_id"), "txn_id", "left_anti") for f, x in zip(both, late))), "partials")
    return trends.refreshed(stored, rebuild, *both, trends.touched_days(*late))


@query
def trend_refreshed(bank: Bank) -> DataFrame:
    """The daily trend after two deliveries; only days that the second one touches are made anew."""
    build = lambda b, c: trends.day_partials(b, c, bank.accounts, bank.cards, bank.customers)
    return trends.daily_trend(_refreshed(bank, build))


@query
def active_refreshed(bank: Bank) -> DataFrame:
    """Monthly active customers from bitmaps that were brought up to date the same way."""
    build = lambda b, c: trends.active_bitmaps(b, c, bank.accounts, bank.cards, bank.numbers)
    return trends.active_from_bitmaps(_refreshed(bank, build), "month")


@query
def agg_txn_dates(bank: Bank) -> DataFrame:
    """Activity as of two dates, from one scan of the facts."""
    return bank.activities(PREVIOUS, AS_OF)


# --- dashboard --------------------------------------------------------------------------------


def _register(name: str, build: Callable[[Bank], DataFrame]) -> None:
    QUERIES[name] = build


_SLICE_QUERIES = {
    "dash_kpis": dashboard.kpis,
    "dash_segment_mix": dashboard.segment_mix,
    "dash_penetration": dashboard.penetration,
    "dash_rfm_counts": dashboard.rfm_counts,
    "dash_province": dashboard.province_counts,
    "dash_rfm_grid": dashboard.rfm_grid,
    "dash_aum_by_rfm": dashboard.deposits_by_rfm,
    "dash_recency_monetary": dashboard.recency_monetary,
    "dash_product_count": dashboard.product_counts,
    "dash_aum_band": dashboard.deposit_bands,
    "dash_penetration_by_segment": dashboard.penetration_by_segment,
    "dash_top_category": dashboard.top_categories,
    "dash_npl_by_segment": dashboard.npl_by_segment,
    "dash_leads": dashboard.leads,
    "dash_leads_by_segment": dashboard.leads_by_segment,
    "dash_utilisation_band": dashboard.utilisation_bands,
}
for _name, _build in _SLICE_QUERIES.items():
    _register(_name, lambda bank, build=_build: build(bank.snapshot))

_register("dash_txn_trend", lambda bank: trends.txn_trend(bank.trend, "month"))
_register("dash_txn_trend_daily", lambda bank: trends.txn_trend(bank.trend, "day"))
_register(
    "dash_active_trend",
    lambda bank: trends.active_trend(trends.active_from_bitmaps(bank.bitmaps, "month"), "month"),
)
_register(
    "dash_active_trend_daily",
    lambda bank: trends.active_trend(trends.active_from_bitmaps(bank.bitmaps, "day"), "day"),
)
_register("dash_channel_trend", lambda bank: trends.channel_trend(bank.trend, "month"))
_register("dash_snapshot_trend", lambda bank: dashboard.snapshot_trend(bank.snapshots))
_register("dash_filter_values", lambda bank: dashboard.filter_values(bank.snapshots, bank.trend))


# --- report measures --------------------------------------------------------------------------


@query
def bi_bands(bank: Bank) -> DataFrame:
    return measures.with_bands(bank.snapshot).select(
        "customer_id",
        "age_band",
        "tenure_years",
        "tenure_band",
        "aum_band",
        "engagement_status",
        "digital_persona",
        "rfm_sort",
    )


_register("bi_kpi", lambda bank: measures.measure(bank.snapshot, measures.kpi_measures()))
_register("bi_products", lambda bank: measures.measure(bank.snapshot, measures.product_measures()))
_register("bi_rfm", lambda bank: measures.measure(bank.snapshot, measures.rfm_measures()))
_register("bi_aum_by_rfm", lambda bank: measures.value_by_rfm(bank.snapshot))
_register(
    "bi_digital",
    lambda bank: rounded(
        measures.measure(bank.snapshot, measures.digital_measures()),
        "avg_digital_ratio",
        "avg_monthly_spend_million",
    ),
)
_register(
    "bi_risk",
    lambda bank: rounded(
        measures.measure(bank.snapshot, measures.risk_measures()), "avg_credit_utilization"
    ),
)
_register(
    "bi_averages",
    lambda bank: rounded(
        measures.measure(bank.snapshot, measures.average_measures()), "avg_tenure_years"
    ),
)
_GROUPS = {
    "bi_age_gender": ("age_band", "gender"),
    "bi_tenure": ("tenure_band",),
    "bi_kyc": ("kyc_status",),
    "bi_engagement": ("engagement_status",),
    "bi_persona": ("digital_persona",),
    "bi_active_months": ("active_months_12m",),
}
for _name, _columns in _GROUPS.items():
    _register(
        _name,
        lambda bank, columns=_columns: measures.customers_by(
            measures.with_bands(bank.snapshot), *columns
        ),
    )
_register("bi_top_provinces", lambda bank: measures.top_provinces(bank.snapshot))
_register("bi_segment_matrix", lambda bank: measures.segment_matrix(bank.snapshot))
_register("bi_rfm_matrix", lambda bank: measures.rfm_matrix(bank.snapshot))
_register("bi_recency_histogram", lambda bank: measures.recency_histogram(bank.snapshot))
_register("bi_champions", lambda bank: measures.champions_list(bank.snapshot))
_register("bi_invest", lambda bank: measures.invest_list(bank.snapshot))
_register("bi_customer_points", lambda bank: measures.customer_points(bank.snapshot))
_register(
    "bi_npl_by_segment",
    lambda bank: measures.measure(
        bank.snapshot,
        {k: v for k, v in measures.risk_measures().items() if k.startswith("npl_")},
        ("customer_segment",),
    ),
)
_register(
    "bi_leads_by_segment",
    lambda bank: measures.measure(
        bank.snapshot,
        {k: v for k, v in measures.risk_measures().items() if k.endswith(("leads", "any_lead"))},
        ("customer_segment",),
    ),
)
