"""Upkeep of stored tables: masking of old snapshots and compaction."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import functions as F

from clientlens.plans.governance import leaky_snapshots, remask
from clientlens.sources.lake import Dimension, LakeTable


def remask_snapshots(mart: LakeTable) -> int:
    """Rewrite the snapshots that hold unmasked names; returns the rows rewritten.

    Snapshots without a leak are not touched, and a second run finds nothing to do. The folders with
    the raw names are deleted once the masked ones count; raw names are written nowhere else.
    """
    rows = mart.read()
    leaky = [r[0] for r in leaky_snapshots(rows).collect()]
    if not leaky:
        return 0
    known = [d for d in leaky if d is not None]
    day = F.col("snapshot_date")
    chosen = day.isin(known) | (day.isNull() if None in leaky else F.lit(False))
    masked = mart.overwrite_partitions(remask(rows.filter(chosen)))
    mart.vacuum(datetime.now(timezone.utc))
    return masked


def compact_tables(tables: Mapping[str, LakeTable | Dimension]) -> dict[str, int | Exception]:
    """Compact every table; one failure does not stop the rest. Returns rows or the error."""
    summary: dict[str, int | Exception] = {}
    for name, table in tables.items():
        try:
            summary[name] = table.compact()
        except Exception as error:  # noqa: BLE001 - reported per table
            summary[name] = error
    return summary


def vacuum_tables(tables: Mapping[str, LakeTable | Dimension], before: datetime | None = None) -> dict[str, int | Exception]:
    """Delete what every table has superseded since before a time, a week ago if none is given."""
    summary: dict[str, int | Exception] = {}
    for name, table in tables.items():
        try:
            summary[name] = table.vacuum(before)
        except Exception as error:  # noqa: BLE001 - reported per table
            summary[name] = error
    return summary
