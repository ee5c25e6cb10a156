"""Points in time passed in from outside. Time without a zone is taken as UTC."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_utc(moment: datetime) -> datetime:
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def instant(moment: datetime) -> Column:
    """The moment as a TIMESTAMP literal, whatever the local time zone of the driver."""
    return F.lit(as_utc(moment)).cast("timestamp")
