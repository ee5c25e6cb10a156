"""Incremental ingest operators: change windows, watermarks and the current state of batches."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.functions.times import instant
from clientlens.operators.cleansing import latest_per_key

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def change_window(
    df: DataFrame, change_column: str, last: datetime | None, now: datetime
) -> DataFrame:
    """Rows changed after ``last`` and not after ``now``; everything if there was no last run.

    Rows without a change time never qualify for an incremental run.
    """
    if last is None:
        return df
    changed = F.col(change_column)
    return df.filter((changed > instant(last)) & (changed <= instant(now)))


def watermarks(audit: DataFrame) -> DataFrame:
    """Latest successful run time of every table."""
    return (
        audit.filter("status = 'SUCCESS'")
        .groupBy("table_name")
        .agg(F.max("current_run_time").alias("last_run_time"))
    )


def last_run_time(audit: DataFrame, table: str) -> datetime | None:
    """Latest successful run time of one table, None if it never succeeded."""
    micros = (
        audit.filter((F.col("table_name") == table) & (F.col("status") == "SUCCESS"))
        .agg(F.unix_micros(F.max("current_run_time")))
        .first()[0]
    )
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def with_ingest_meta(df: DataFrame, run_ts: datetime, source: str, batch_id: str) -> DataFrame:
    """Stamp rows with the run time, source system and batch."""
    return df.withColumns(
        {
            "_ingested_at": instant(run_ts),
            "_source_system": F.lit(source),
            "_batch_id": F.lit(batch_id),
        }
    )


def current_rows(batches: DataFrame, key: str) -> DataFrame:
    """State after upserting all batches in time order: the latest row of every key."""
    return latest_per_key(batches, [key], ["_ingested_at", "_batch_id"])
