"""Gold: the two customer aggregates and the mart snapshot, in order."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.config import SILVER_TABLES, GoldSettings
from clientlens.functions.times import instant
from clientlens.jobs.audit import AuditLog, run_steps
from clientlens.jobs.conform import silver_table
from clientlens.plans.activity import customer_activity, latest_transaction_date
from clientlens.plans.holdings import customer_holdings
from clientlens.plans.mart import customer_mart
from clientlens.schemas import GOLD
from clientlens.sources.lake import Lake, LakeTable

LAYER = "gold"
_SILVER = {t.name: t for t in SILVER_TABLES}


def gold_table(lake: Lake, name: str) -> LakeTable:
    if name == "mart_customer_360":
        return lake.table(LAYER, name, GOLD[name], "snapshot_date", lookup="customer_id")
    return lake.table(LAYER, name, GOLD[name])


def _silver(lake: Lake, name: str) -> DataFrame:
    return silver_table(lake, _SILVER[name]).read()


def with_gold_meta(df: DataFrame, batch_id: str, run_ts: datetime) -> DataFrame:
    return df.withColumns(
        {"_gold_loaded_at": instant(run_ts), "_gold_batch_id": F.lit(batch_id)}
    )


def resolve_as_of(lake: Lake, settings: GoldSettings) -> date:
    """The configured date, or the latest transaction in the facts."""
    if settings.as_of is not None:
        return settings.as_of
    return latest_transaction_date(
        _silver(lake, "fct_bank_transactions"), _silver(lake, "fct_card_transactions")
    )


def build_holdings(lake: Lake, as_of: date, run_ts: datetime, batch_id: str) -> int:
    frame = customer_holdings(
        _silver(lake, "dim_customer"),
        _silver(lake, "dim_account"),
        _silver(lake, "dim_card_account"),
        _silver(lake, "dim_loan"),
        as_of,
    )
    target = gold_table(lake, "agg_customer_holdings")
    return target.replace(with_gold_meta(frame, batch_id, run_ts), run_ts, batch_id)


def build_activity(
    lake: Lake, as_of: date, run_ts: datetime, batch_id: str, settings: GoldSettings
) -> int:
    frame = customer_activity(
        _silver(lake, "fct_bank_transactions"),
        _silver(lake, "fct_card_transactions"),
        _silver(lake, "dim_account"),
        _silver(lake, "dim_card_account"),
        as_of,
        settings,
    )
    target = gold_table(lake, "agg_customer_txn_12m")
    return target.replace(with_gold_meta(frame, batch_id, run_ts), run_ts, batch_id)


def build_mart(
    lake: Lake, as_of: date, run_ts: datetime, batch_id: str, settings: GoldSettings
) -> int:
    """Publish the snapshot of one date; other snapshots stay as they are."""
    frame = customer_mart(
        _silver(lake, "dim_customer"),
        gold_table(lake, "agg_customer_holdings").read(),
        gold_table(lake, "agg_customer_txn_12m").read(),
        as_of,
        settings,
    )
    target = gold_table(lake, "mart_customer_360")
    return target.overwrite_partitions(with_gold_meta(frame, batch_id, run_ts))


def run_gold(
    lake: Lake, run_ts: datetime, batch_id: str, settings: GoldSettings | None = None
) -> dict[str, int]:
    """Build both aggregates, then the mart; the first failure stops the run."""
    settings = settings or GoldSettings()
    as_of = resolve_as_of(lake, settings)
    steps = [
        (
            "agg_customer_holdings",
            "gold",
            "overwrite",
            lambda: build_holdings(lake, as_of, run_ts, batch_id),
        ),
        (
            "agg_customer_txn_12m",
            "gold",
            "overwrite",
            lambda: build_activity(lake, as_of, run_ts, batch_id, settings),
        ),
        (
            "mart_customer_360",
            "gold",
            "overwrite",
            lambda: build_mart(lake, as_of, run_ts, batch_id, settings),
        ),
    ]
    return run_steps(AuditLog(lake, LAYER), steps, batch_id, run_ts, stop_on_failure=True)
