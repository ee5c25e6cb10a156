"""Exact money arithmetic over columns stored as DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(amount: Column) -> Column:
    """The amount as a fixed-point number, so that sums do not depend on row order."""
    return amount.cast("decimal(18,2)")


def total(amount: Column) -> Column:
    """Exact sum of an amount column, 0 for an empty group, published as DOUBLE."""
    return F.coalesce(F.sum(exact(amount)).cast("double"), F.lit(0.0))
