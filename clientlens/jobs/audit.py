"""The audit log of a layer, and the loop that runs steps and records each outcome."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from clientlens.operators.incremental import last_run_time
from clientlens.schemas import AUDIT
from clientlens.sources.lake import Lake


class JobFailed(RuntimeError):
    """Raised after all steps ran, if any of them failed."""

    def __init__(self, failures: dict[str, Exception]):
        self.failures = failures
        super().__init__("; ".join(f"{name}: {error}" for name, error in failures.items()))


class AuditLog:
    """Append-only log of runs, one row per table and run."""

    def __init__(self, lake: Lake, layer: str):
        self.spark: SparkSession = lake.spark
        self.table = lake.table(layer, "audit_log", AUDIT)

    def append(
        self,
        batch_id: str,
        table: str,
        source: str,
        run_mode: str,
        rows: int,
        run_ts: datetime,
        last_run: datetime | None = None,
        error: Exception | None = None,
    ) -> None:
        status = "SUCCESS" if error is None else "FAILED"
        message = None if error is None else str(error)
        now = datetime.now(timezone.utc)
        row = (batch_id, table, source, run_mode, status, rows, last_run, run_ts, message, now)
        entry = self.spark.createDataFrame([row], AUDIT)
        self.table.append(entry.coalesce(1))

    def read(self) -> DataFrame:
        return self.table.state()

    def compact(self) -> int:
        """One row is one small file; gather them."""
        return self.table.compact()

    def vacuum(self, before: datetime | None = None) -> int:
        return self.table.vacuum(before)

    def last_run_time(self, table: str) -> datetime | None:
        """Latest successful run of a table; only a missing log counts as no run at all."""
        return last_run_time(self.read(), table)


def run_steps(
    log: AuditLog,
    steps: Iterable[tuple[str, str, str, Callable[[], int | tuple[int, datetime | None]]]],
    batch_id: str,
    run_ts: datetime,
    stop_on_failure: bool,
) -> dict[str, int]:
    """Run (table, source, mode, step) in order and audit each one.

    A failure either stops the run or, where steps are independent, is raised at the end. A step
    gives its rows, or its rows and the time up to which it has read its own source.
    """
    written: dict[str, int] = {}
    failures: dict[str, Exception] = {}
    for table, source, run_mode, step in steps:
        try:
            done = step()
            written[table], last_run = done if isinstance(done, tuple) else (done, None)
        except Exception as error:  # noqa: BLE001 - every failure is recorded and raised later
            log.append(batch_id, table, source, run_mode, 0, run_ts, error=error)
            failures[table] = error
            if stop_on_failure:
                raise
            continue
        log.append(batch_id, table, source, run_mode, written[table], run_ts, last_run)
    if failures:
        raise JobFailed(failures)
    return written
