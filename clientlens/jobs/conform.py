"""Silver: conformed dimensions with history, and facts without duplicates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.config import SILVER_TABLES, UPPER_COLUMNS, SilverTable
from clientlens.functions.times import as_utc, instant
from clientlens.jobs.audit import AuditLog, run_steps
from clientlens.jobs.ingest import LAYER as BRONZE_LAYER
from clientlens.jobs.ingest import bronze_table
from clientlens.operators import scd
from clientlens.operators.cleansing import conform, with_silver_meta
from clientlens.operators.incremental import last_run_time
from clientlens.schemas import SILVER, align_to_schema
from clientlens.sources.lake import Dimension, Lake, LakeTable
from clientlens.sources.scratch import materialise

LAYER = "silver"
#: Key ranges of a delivery that stored facts are searched in.
ZONES = 32


def silver_table(lake: Lake, table: SilverTable) -> LakeTable | Dimension:
    if table.kind == "scd2":
        return lake.dimension(LAYER, table.name, SILVER[table.name])
    if table.kind == "scd1":
        return lake.table(LAYER, table.name, SILVER[table.name], table.key, buckets=table.buckets, lookup=table.key)
    by_month = table.partition is not None and table.grain == "month"
    return lake.table(LAYER, table.name, SILVER[table.name], table.partition, by_month)


def new_batches(lake: Lake, table: SilverTable) -> tuple[list[str] | None, datetime | None]:
    """Bronze batches that no successful silver run has read, and the run time of the latest one.

    None stands for all of bronze: before the first silver run of a table, and where its bronze table
    has no audited run. The audit logs have a row for each run of a table.
    """
    runs = AuditLog(lake, BRONZE_LAYER).read().filter(
        (F.col("table_name") == table.bronze) & (F.col("status") == "SUCCESS")
    )
    done = AuditLog(lake, LAYER).read().filter(
        (F.col("table_name") == table.name) & (F.col("status") == "SUCCESS")
    )
    latest = last_run_time(runs, table.bronze)
    read_to = done.agg(F.unix_micros(F.max("last_run_time"))).first()[0]
    if read_to is None or latest is None:
        return None, latest
    later = runs.filter(F.unix_micros("current_run_time") > read_to)
    return [r[0] for r in later.select("batch_id").distinct().collect()], latest


def delivered(lake: Lake, table: SilverTable, batches: Sequence[str] | None = None) -> DataFrame:
    """Cleansed bronze rows of a table, one per key; optionally of some batches only. A load that looks
    at its delivery more than once stores it."""
    rows = bronze_table(lake, table.bronze).read()
    if batches is not None:
        rows = rows.filter(F.col("_batch_id").isin(list(batches)))
    return conform(rows, [table.key], UPPER_COLUMNS[table.kind], ("_ingested_at", "_batch_id"))


def _stamped(incoming: DataFrame, table: SilverTable, run_ts: datetime, batch_id: str, first: bool) -> DataFrame:
    """The rows of a delivery as the table has them; stored, unless it is the ``first`` load of the table,
    which reads them once."""
    stored = incoming if first else materialise(incoming, "delivered")
    return align_to_schema(with_silver_meta(stored, batch_id, run_ts), SILVER[table.name])


def load_scd1(
    lake: Lake,
    table: SilverTable,
    run_ts: datetime,
    batch_id: str,
    batches: Sequence[str] | None = None,
) -> int:
    """Upsert a type 1 dimension and return the number of rows written.

    Only the key buckets that the delivery hits are read and written again; all of them where the
    table was dealt to another number of buckets.
    """
    target = silver_table(lake, table)
    first = not target.exists()
    incoming = _stamped(delivered(lake, table, batches), table, run_ts, batch_id, first)
    touched = None if first else target.touched(incoming)
    if touched is None:
        return target.replace(scd.scd1_merge(target.state(), incoming, table.key), run_ts, batch_id)
    return target.overwrite_partitions(scd.scd1_merge(touched, incoming, table.key))


def zones(keys: DataFrame, key: str, count: int = ZONES) -> list[tuple]:
    """Smallest and largest key of about ``count`` ranges of equally many keys; that many rows come to
    the driver, whatever their number."""
    dealt = keys.select(key).filter(F.col(key).isNotNull()).repartitionByRange(count, key)
    return [tuple(r) for r in dealt.groupBy(F.spark_partition_id()).agg(F.min(key).alias("low"), F.max(key).alias("high")).select("low", "high").collect()]


def load_scd2(
    lake: Lake,
    table: SilverTable,
    run_ts: datetime,
    batch_id: str,
    batches: Sequence[str] | None = None,
    refresh_attributes: bool = False,
) -> int:
    """Close and open versions with one load; returns the versions opened.

    The load counts only if a version opened, or if attributes are refreshed. A retry of a run that
    was published, with the same run time and batch, does nothing. Closed versions of earlier runs
    are not read.
    """
    target = silver_table(lake, table)
    before = target.published()
    micros = int(as_utc(run_ts).timestamp()) * 1_000_000 + as_utc(run_ts).microsecond
    if before is not None and before["run_ts"] >= micros:
        if (before["run_ts"], before["batch_id"]) == (micros, batch_id):
            return target.current().filter(F.col("effective_from") == instant(run_ts)).count()
        raise ValueError(f"run time {run_ts} is not after the latest version")
    incoming = delivered(lake, table, batches)
    state = scd.scd2_apply(target.current(), incoming, table, run_ts, batch_id, refresh_attributes)
    opened = F.count_if(F.col("is_current") & (F.col("effective_from") == instant(run_ts)))
    folder, figures = target.versions.draft(state, opened=opened)
    if before is None or figures["opened"] or refresh_attributes:
        if before is not None:
            target.move_closed()
        target.versions.publish(folder, run_ts, batch_id)
    return figures["opened"]


def load_fact(
    lake: Lake,
    table: SilverTable,
    run_ts: datetime,
    batch_id: str,
    batches: Sequence[str] | None = None,
    stable_dates: bool = False,
    update: bool = False,
) -> int:
    """Add the transactions that are not stored yet and return their number.

    Stored keys are searched only in the ranges of delivered ones: these reach the Parquet footers, so
    new keys beyond the stored ones read no row group, whatever has been stored.
    ``stable_dates`` states that a key never changes its date, so only the dates of the
    delivery, and rows without a date, need to be searched. With ``update`` stored transactions
    take the delivered values; the partitions they touch are rewritten.
    """
    target = silver_table(lake, table)
    stored = target.state()
    first = not target.exists()
    incoming = _stamped(delivered(lake, table, batches), table, run_ts, batch_id, first)
    day = F.col(table.partition)
    if first:
        return target.replace(incoming, run_ts, batch_id)
    if update:
        return _update(target, stored, incoming, table)
    if stable_dates:
        low, high = incoming.agg(F.min(day), F.max(day)).first()
        stored = stored.filter(day.isNull() | (day.between(low, high) if low is not None else F.lit(False)))
    near = F.lit(False)
    for low, high in zones(incoming, table.key):
        near |= F.col(table.key).between(low, high)
    return target.append(scd.fact_new_rows(stored.filter(near), incoming, table.key))


def _update(target: LakeTable, stored: DataFrame, incoming: DataFrame, table: SilverTable) -> int:
    """Rewrite the partitions that a delivery touches, that without a date among them."""
    part = target.part_of()
    matched = stored.join(incoming.select(table.key), table.key, "left_semi").select(part.alias("touched"))
    touched = matched.union(incoming.select(part)).distinct()
    affected = stored.join(touched, part.eqNullSafe(F.col("touched")), "left_semi")
    merged = materialise(scd.scd1_merge(affected, incoming, table.key), "merged")
    emptied = touched.join(merged.select(part.alias("left")).distinct(), F.col("touched").eqNullSafe(F.col("left")), "left_anti")
    if not emptied.isEmpty():
        # Overwriting partitions can't empty one: all of its rows moved to others.
        return target.replace(scd.scd1_merge(stored, incoming, table.key))
    return target.overwrite_partitions(merged)


_LOADERS = {"scd1": load_scd1, "scd2": load_scd2, "fact": load_fact}
#: What each loader can be asked for.
OPTIONS = {"scd1": (), "scd2": ("refresh_attributes",), "fact": ("stable_dates", "update")}


def run_conform(
    lake: Lake,
    run_ts: datetime,
    batch_id: str,
    tables: Sequence[SilverTable] = SILVER_TABLES,
    only_batch: str | None = None,
    everything: bool = False,
    **options: bool,
) -> dict[str, int]:
    """Load all silver tables. One that fails is recorded and the others go on; then it is raised.

    Each table reads the bronze batches that its last successful run had not read, or
    ``only_batch``, or ``everything``. ``options`` (refresh_attributes, stable_dates, update) go to
    the loaders that know them.
    """

    def step(table: SilverTable) -> Callable[[], tuple[int, datetime | None]]:
        def run() -> tuple[int, datetime | None]:
            batches, latest = (None, None) if everything else new_batches(lake, table)
            if only_batch is not None:
                batches, latest = [only_batch], None
            chosen = {k: v for k, v in options.items() if k in OPTIONS[table.kind]}
            return _LOADERS[table.kind](lake, table, run_ts, batch_id, batches, **chosen), latest

        return run

    steps = [(t.name, "silver", t.kind, step(t)) for t in tables]
    return run_steps(AuditLog(lake, LAYER), steps, batch_id, run_ts, stop_on_failure=False)
