"""Row and value cleansing shared by all silver tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, VariantType

from clientlens.functions.times import instant


def clean_strings(df: DataFrame) -> DataFrame:
    """Strip surrounding spaces from every string column; empty text becomes NULL."""
    return df.select(
        *[
            F.nullif(F.trim(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def upper_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Upper-case those of the listed columns that the frame has."""
    return df.withColumns({c: F.upper(c) for c in columns if c in df.columns})


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove rows in which any key column is NULL."""
    return df.dropna(how="any", subset=list(keys))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep one row per key: the latest by ``order_by``, ties broken by all other columns.

    The ``row_number() = 1`` filter lets Spark discard all but one row per key on the map side,
    before the shuffle, so a key that owns a large share of the rows costs no more than any other.
    Columns that can't be ordered (maps, variants) can't break ties; frames with one are refused.
    """
    unordered = [f.name for f in df.schema if isinstance(f.dataType, (MapType, VariantType))]
    if unordered:
        raise ValueError(f"rows can't be ordered by {', '.join(unordered)}: cast or drop them first")
    leading = [c for c in order_by if c in df.columns]
    ties = [c for c in df.columns if c not in keys and c not in leading]
    newest_first = Window.partitionBy(*keys).orderBy(
        *[F.desc_nulls_last(c) for c in leading + ties] or [F.lit(1)]
    )
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def with_silver_meta(df: DataFrame, batch_id: str, run_ts: datetime) -> DataFrame:
    """Stamp rows with the load time and batch."""
    return df.withColumns(
        {"_silver_loaded_at": instant(run_ts), "_silver_batch_id": F.lit(batch_id)}
    )


def conform(
    df: DataFrame,
    keys: Sequence[str],
    upper: Iterable[str],
    order_by: Sequence[str] = ("_ingested_at",),
) -> DataFrame:
    """All cleansing steps in their fixed order: text, codes, keys, duplicates."""
    cleaned = upper_columns(clean_strings(df), upper)
    return latest_per_key(drop_null_keys(cleaned, keys), keys, order_by)
