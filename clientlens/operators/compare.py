"""Comparison of two versions of a table.

:func:`changes` compares by digests first: the rows of each key bucket are summed up, whatever their
order, and only buckets whose sums differ are joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Key buckets of a comparison; the driver gets the numbers of those that differ.
BUCKETS = 4096


def compare_versions(
    old: DataFrame,
    new: DataFrame,
    key: str,
    columns: Sequence[str],
    changed_only: bool = False,
) -> DataFrame:
    """Old and new values side by side for every key that is in both versions."""
    before = old.select(key, *[F.col(c).alias(f"old_{c}") for c in columns])
    after = new.select(key, *[F.col(c).alias(f"new_{c}") for c in columns])
    both = before.join(after, key)
    if changed_only:
        both = both.filter(
            reduce(or_, [~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in columns])
        )
    return both


def key_changes(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys that were added, removed or changed between two versions."""
    before = old.select(key, F.struct(*columns).alias("old"))
    after = new.select(key, F.struct(*columns).alias("new"))
    return (
        before.join(after, key, "full_outer")
        .select(
            key,
            F.when(F.col("old").isNull(), "ADDED")
            .when(F.col("new").isNull(), "REMOVED")
            .when(~F.col("old").eqNullSafe(F.col("new")), "CHANGED")
            .alias("change"),
        )
        .filter("change IS NOT NULL")
    )


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _row_hash(key: str, columns: Sequence[str], seed: int) -> Column:
    # A NULL leaves Spark's hash as it is, so that it is one is hashed beside it.
    marks = [F.col(c).isNull() for c in columns]
    return F.xxhash64(F.lit(seed), key, *columns, *marks).cast("decimal(20,0)")


def differing_buckets(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """The key buckets whose rows are not the same in both versions.

    A bucket's digest is its number of rows and two sums of 64-bit hashes, so it doesn't depend on their
    order and is combined on the map side: a task sends one row for each bucket, however large the
    table or hot a bucket. Two different buckets look equal with a probability of about 2^-128.
    """
    sides = [
        df.filter(F.col(key).isNotNull()).select(
            bucket_of(key, buckets).alias("bucket"),
            F.lit(sign).cast("long").alias("n"),
            *((_row_hash(key, columns, seed) * sign).alias(f"h{seed}") for seed in (0, 1)),
        )
        for df, sign in ((old, -1), (new, 1))
    ]
    sums = sides[0].unionByName(sides[1]).groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("n", "h0", "h1")))
    return sorted(r[0] for r in sums.filter("n <> 0 OR h0 <> 0 OR h1 <> 0").select("bucket").collect())


def changes(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``key``, ``change`` (ADDED, REMOVED or CHANGED), and ``old_`` and ``new_`` values of all keys that
    differ; equal versions end without a join.

    Keys must be unique in a version; rows without key are left out; NULL equals NULL.
    """
    found = differing_buckets(old, new, key, columns, buckets)
    if not found:
        wide = [f"{side}_{c}" for side in ("old", "new") for c in columns]
        types = [old.schema[key].dataType, "string", *(df.schema[c].dataType for df in (old, new) for c in columns)]
        nothing = old.sparkSession.range(0)
        return nothing.select(*(F.lit(None).cast(t).alias(n) for n, t in zip([key, "change", *wide], types)))
    hit = F.col(key).isNotNull()
    if len(found) < buckets:
        hit &= bucket_of(key, buckets).isin(found)
    sides = [
        df.filter(hit).select(key, F.lit(True).alias(f"in_{name}"), *(F.col(c).alias(f"{name}_{c}") for c in columns))
        for df, name in ((old, "old"), (new, "new"))
    ]
    differs = reduce(or_, (~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in columns), F.lit(False))
    change = F.when(F.col("in_old").isNull(), "ADDED").when(F.col("in_new").isNull(), "REMOVED").when(differs, "CHANGED")
    both = sides[0].join(sides[1], key, "full_outer").withColumn("change", change).filter("change IS NOT NULL")
    return both.select(key, "change", *(f"{name}_{c}" for name in ("old", "new") for c in columns))
