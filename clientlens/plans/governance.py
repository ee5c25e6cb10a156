"""Repairs of stored mart snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.functions.masking import is_raw_name, mask_name


def leaky_snapshots(mart: DataFrame) -> DataFrame:
    """Snapshot dates that still hold unmasked names."""
    return mart.filter(is_raw_name(F.col("full_name"))).select("snapshot_date").distinct()


def remask(mart: DataFrame) -> DataFrame:
    """Mask the names that are still raw; masked names stay as they are."""
    name = F.col("full_name")
    return mart.withColumn("full_name", F.when(is_raw_name(name), mask_name(name)).otherwise(name))
