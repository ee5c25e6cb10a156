"""Slowly changing dimensions and insert-only facts, as pure frame-to-frame operators.

None of them writes a table. Each takes the stored state and one delivery and returns the next state
(or the rows to add), so a job can publish the outcome in one step.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientlens.config import SilverTable
from clientlens.functions.times import as_utc, instant
from clientlens.sources.scratch import materialise

_VERSION_COLUMNS = (
    "row_hash",
    "effective_from",
    "effective_to",
    "is_current",
    "version",
    "_silver_loaded_at",
    "_silver_batch_id",
)


def scd1_merge(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Next state of a type 1 dimension: delivered rows replace stored rows of the same key.

    Rows that are absent from the delivery stay. ``incoming`` holds one row per key.
    """
    kept = stored.join(incoming.select(key), key, "left_anti")
    return kept.select(*stored.columns).unionByName(incoming.select(*stored.columns))


def row_hash(tracked: Sequence[str]) -> Column:
    """Digest of the tracked columns: MD5 of their texts joined with '|', NULL as ''."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in tracked]
    return F.md5(F.concat_ws("|", *texts))


def surrogate_key(key: str, run_ts: datetime) -> Column:
    """Key of one version: MD5 of the natural key and the run time to the second."""
    return F.md5(F.concat(F.col(key), F.lit(f"|{as_utc(run_ts):%Y-%m-%d %H:%M:%S}")))


def version_columns(table: SilverTable) -> list[str]:
    """Column order of a type 2 dimension."""
    return [
        table.surrogate,
        table.key,
        *table.attributes,
        *table.tracked,
        *_VERSION_COLUMNS,
    ]


def _differs(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(or_, [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def scd2_changes(history: DataFrame, incoming: DataFrame, table: SilverTable) -> DataFrame:
    """Delivered rows that open a version: unknown keys, and keys whose tracked values moved.

    Adds ``change`` (NEW or CHANGED) and ``old_version``. Values are compared one by one, so
    two different rows can never pass as equal because their digests coincide.
    """
    current = history.filter("is_current").select(
        table.key, F.struct("version", *table.tracked).alias("cur")
    )
    paired = incoming.withColumn("src", F.struct(*table.tracked)).join(current, table.key, "left")
    is_new = F.col("cur").isNull()
    return (
        paired.withColumn(
            "change",
            F.when(is_new, "NEW").when(_differs("cur", "src", table.tracked), "CHANGED"),
        )
        .filter("change IS NOT NULL")
        .withColumn("old_version", F.col("cur.version"))
        .drop("cur", "src")
    )


def scd2_apply(
    history: DataFrame,
    incoming: DataFrame,
    table: SilverTable,
    run_ts: datetime,
    batch_id: str,
    refresh_attributes: bool = False,
) -> DataFrame:
    """Next state of a type 2 dimension: versions closed and opened by one delivery.

    Current rows meet the delivery in a single join, which emits the closed and the opened
    version of a key side by side; closed history passes through untouched. Attributes that
    are not tracked reach the table with the next version, or at once with
    ``refresh_attributes``.
    """
    columns = version_columns(table)
    past = history.filter("NOT is_current").select(*columns)
    current = history.filter("is_current").select(
        F.col(table.key).alias("_key"), F.struct(*columns).alias("old")
    )
    run_time = instant(run_ts)
    opened_values = {
        table.surrogate: surrogate_key(table.key, run_ts),
        "row_hash": row_hash(table.tracked),
        "effective_from": run_time,
        "effective_to": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
        "version": F.lit(1),
        "_silver_loaded_at": run_time,
        "_silver_batch_id": F.lit(batch_id),
    }
    delivered = incoming.select(
        F.col(table.key).alias("_key"),
        F.struct(*[opened_values.get(c, F.col(c)).alias(c) for c in columns]).alias("new"),
    )
    pairs = current.join(delivered, "_key", "full_outer")

    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    changed = both & _differs("old", "new", table.tracked)
    closed = F.col("old").withField("is_current", F.lit(False)).withField("effective_to", run_time)
    kept = F.col("old")
    if refresh_attributes:
        fresh = kept
        for name in table.attributes:
            fresh = fresh.withField(name, F.col(f"new.{name}"))
        kept = F.when(both, fresh).otherwise(kept)
    stays = F.when(changed, closed).otherwise(kept)
    next_version = F.coalesce(F.col("old.version"), F.lit(0)) + 1
    opens = F.when(
        F.col("old").isNull() | changed, F.col("new").withField("version", next_version)
    )
    present = pairs.select(F.inline(F.array_compact(F.array(stays, opens))))
    return past.unionByName(present.select(*columns))


def check_advances(history: DataFrame, run_ts: datetime) -> None:
    """Refuse a run time that is not later than every version in the table."""
    if not history.filter(F.col("effective_from") >= instant(run_ts)).isEmpty():
        raise ValueError(f"run time {run_ts} is not after the latest version")


def scd2_as_of(history: DataFrame, moment: datetime) -> DataFrame:
    """Versions that were valid at one point in time."""
    at = instant(moment)
    return history.filter(
        (F.col("effective_from") <= at)
        & (F.col("effective_to").isNull() | (at < F.col("effective_to")))
    )


#: Facts of a key from which on its time is cut into slices of about as many.
SLICE_FACTS = 1_000_000


def join_as_of(
    facts: DataFrame, history: DataFrame, key: str, moment: str, columns: Sequence[str], slice_facts: int = SLICE_FACTS
) -> DataFrame:
    """Facts with the dimension columns that were valid at each fact's own time; NULL where none was.

    Facts and versions go into one frame, sorted by key and time, and each fact takes the version that
    was carried forward to it: no fact meets a second version, however many its key has. A key of more
    than ``slice_facts`` facts is cut into slices of time, which are tasks of their own; a version is
    copied to the slices that it reaches. ``history`` has versions that don't overlap, as type 2
    dimensions have. Facts without key or time get NULL.
    """
    at = F.col(moment).cast("timestamp")
    seconds = F.unix_micros(at) / F.lit(1e6)
    per_key = facts.filter(F.col(key).isNotNull() & at.isNotNull()).groupBy(key)
    spans = per_key.agg(F.count(F.lit(1)).alias("n"), F.min(seconds).alias("low"), F.max(seconds).alias("high"))
    # At most one key for each slice_facts rows, so the table of hot keys is small against the facts.
    hot = spans.filter(F.col("n") > slice_facts).select(
        F.col(key).alias("_hot"), "low", F.greatest(F.col("high") - F.col("low"), F.lit(1e-6)).alias("width"), F.ceil(F.col("n") / slice_facts).alias("slices")
    )
    hot = materialise(hot, "hot-keys")

    def slice_of(time: Column) -> Column:
        nth = F.floor((time - F.col("low")) / F.col("width") * F.col("slices"))
        return F.coalesce(F.greatest(F.lit(0).cast("long"), F.least(nth, F.col("slices") - 1)), F.lit(0).cast("long"))

    # Partitions of the sort: a key, or a slice of a hot one.
    fact = F.struct(*[F.col(c) for c in facts.columns])
    told = facts.select(F.col(key).alias("_key"), at.alias("_at"), seconds.alias("_s"), fact.alias("_fact"))
    told = told.join(F.broadcast(hot), F.col("_key") == F.col("_hot"), "left").select("_key", slice_of(F.col("_s")).alias("_slice"), "_at", "_fact")
    known = history.filter(F.col(key).isNotNull() & F.col("effective_from").isNotNull()).select(
        F.col(key).alias("_key"),
        F.col("effective_from").alias("_at"),
        F.struct("effective_to", *columns).alias("_version"),
        (F.unix_micros("effective_from") / F.lit(1e6)).alias("_s"),
        (F.unix_micros("effective_to") / F.lit(1e6)).alias("_e"),
    )
    last = F.coalesce(slice_of(F.col("_e")), F.lit(0).cast("long"))
    until = F.when(F.col("_hot").isNull(), F.lit(0).cast("long")).when(F.col("_e").isNull(), F.col("slices") - 1).otherwise(last)
    known = known.join(F.broadcast(hot), F.col("_key") == F.col("_hot"), "left").select(
        "_key", F.explode(F.sequence(slice_of(F.col("_s")), until)).alias("_slice"), "_at", "_version"
    )
    both = told.unionByName(known, allowMissingColumns=True)
    ahead = Window.partitionBy("_key", "_slice").orderBy(F.col("_at"), F.col("_fact").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_valid", F.last("_version", ignorenulls=True).over(ahead)).filter("_fact IS NOT NULL")
    ended = F.col("_valid.effective_to") <= F.col("_at")
    reached = F.coalesce(~ended, F.lit(True)) & F.col("_key").isNotNull() & F.col("_at").isNotNull()
    return carried.select("_fact.*", *[F.when(reached, F.col(f"_valid.{c}")).alias(c) for c in columns])


def scd2_history(history: DataFrame, key: str, value: str) -> DataFrame:
    """All versions of one key, oldest first."""
    return history.filter(F.col(key) == value).orderBy("version")


def fact_new_rows(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Delivered rows whose key is not stored yet.

    The stored side is by far the larger one. Only its key column is read, and a semi join
    reduces it to the delivered keys, which needs no shuffle of it while a delivery is small
    enough for Spark to broadcast its keys.
    """
    seen = stored.select(key).join(incoming.select(key), key, "left_semi")
    return incoming.join(seen, key, "left_anti")
