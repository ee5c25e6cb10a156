"""Bronze: copy source tables as delivered, in full or as batches of changes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from clientlens.config import SOURCE_TABLES, SourceTable
from clientlens.jobs.audit import AuditLog, run_steps
from clientlens.operators.incremental import current_rows, with_ingest_meta
from clientlens.schemas import BRONZE
from clientlens.sources.lake import Lake, LakeTable

LAYER = "bronze"
Reader = Callable[[SourceTable, datetime | None, datetime], DataFrame]


def bronze_table(lake: Lake, name: str) -> LakeTable:
    return lake.table(LAYER, name, BRONZE[name], "_batch_id")


def bronze_current(lake: Lake, table: SourceTable) -> DataFrame:
    """Present state of a bronze table: the latest delivery of every key."""
    return current_rows(bronze_table(lake, table.bronze).read(), table.key)


def ingest_table(
    lake: Lake,
    table: SourceTable,
    read: Reader,
    last: datetime | None,
    run_ts: datetime,
    batch_id: str,
) -> int:
    """Ingest one table and return the rows written.

    Without a last run, or for a table without a change column, the source is read in full and
    starts the table anew, so rows that moved or vanished leave nothing behind. Otherwise the
    changes become one more batch, a partition of the table; a repeated batch id replaces its rows.
    A full load is one batch too, and written by the tasks that read it, without a shuffle.
    """
    full = last is None or table.change_column is None
    rows = with_ingest_meta(read(table, None if full else last, run_ts), run_ts, table.source, batch_id)
    target = bronze_table(lake, table.bronze)
    if full:
        return target.replace(rows, run_ts, batch_id, gather=False)
    return target.overwrite_partitions(rows)


def run_ingest(
    lake: Lake,
    read: Reader,
    run_ts: datetime,
    batch_id: str,
    tables: Sequence[SourceTable] = SOURCE_TABLES,
    full: bool = False,
) -> dict[str, int]:
    """Ingest all tables. One that fails is recorded and the others go on; then it is raised."""
    log = AuditLog(lake, LAYER)

    def step(table: SourceTable) -> Callable[[], int]:
        def run() -> int:
            last = None if full else log.last_run_time(table.bronze)
            return ingest_table(lake, table, read, last, run_ts, batch_id)

        return run

    steps = [
        (
            t.bronze,
            t.source,
            "full_snapshot" if full or t.change_column is None else "incremental",
            step(t),
        )
        for t in tables
    ]
    return run_steps(log, steps, batch_id, run_ts, stop_on_failure=False)
