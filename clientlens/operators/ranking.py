"""Exact quantile buckets over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.sources.scratch import materialise

# monotonically_increasing_id() keeps the row number of a partition in its lower 33 bits.
_ROW_BITS = 33


def bucket_ends(n: int, buckets: int) -> list[int]:
    """Rank of the last row of every bucket but the last, as NTILE splits n rows."""
    size, larger = divmod(n, buckets)
    return [b * size + min(b, larger) for b in range(1, buckets)]


def bucket_cuts(
    df: DataFrame, id_column: str, keys: Mapping[str, Column], buckets: int
) -> dict[str, list[tuple[float, str]]]:
    """For every key, the (key, id) of the last row of each bucket but the last.

    All keys are sorted in one range-partitioned pass over (key number, key, id). Because ids
    are unique the range bounds can cut through a run of equal keys, so ties do not pile up
    in one task. The sorted frame is written once; the driver sees one count per partition
    and the cut rows themselves, nothing that grows with the table.
    """
    names = list(keys)
    entries = F.array(
        *[F.struct(F.lit(i).alias("k"), keys[n].cast("double").alias("v")) for i, n in enumerate(names)]
    )
    slim = df.select(F.inline(entries).alias("k", "v"), F.col(id_column).alias("id"))
    ordered = materialise(
        slim.repartitionByRange("k", "v", "id")
        .sortWithinPartitions("k", "v", "id")
        .withColumn("pos", F.monotonically_increasing_id()),
        "ranks",
    )
    per_partition = (
        ordered.groupBy(F.shiftright("pos", _ROW_BITS).alias("part")).count().orderBy("part").collect()
    )
    total = sum(row["count"] for row in per_partition)
    n = total // len(names)
    if n == 0:
        return {name: [] for name in names}

    wanted = {
        (i, rank): i * n + rank - 1 for i in range(len(names)) for rank in bucket_ends(n, buckets)
    }
    starts, start = [], 0
    for row in per_partition:
        starts.append((start, row["count"], row["part"]))
        start += row["count"]
    positions = {}
    for target in set(wanted.values()):
        first, _, part = next(s for s in starts if s[0] <= target < s[0] + s[1])
        positions[target] = (part << _ROW_BITS) + target - first
    cut_rows = {
        r["pos"]: (r["v"], r["id"])
        for r in ordered.filter(F.col("pos").isin(list(positions.values()))).collect()
    }
    return {
        name: [cut_rows[positions[wanted[(i, rank)]]] for rank in bucket_ends(n, buckets)]
        for i, name in enumerate(names)
    }


def with_buckets(df: DataFrame, id_column: str, keys: Mapping[str, Column], buckets: int) -> DataFrame:
    """Add, per key, the NTILE bucket (1..buckets) of each row ordered by (key, id) ascending.

    ``id_column`` must be unique and keys must be numeric and never NULL. The frame is read
    twice, so pass one that is cheap to read again. Assigning the buckets is a comparison
    with literals: it needs no shuffle and no join.
    """
    cuts = bucket_cuts(df, id_column, keys, buckets)
    row_id = F.col(id_column)

    def bucket(key: Column, name: str) -> Column:
        value = key.cast("double")
        passed = [
            ((value > v) | ((value == v) & (row_id > i))).cast("int") for v, i in cuts[name]
        ]
        return reduce(add, passed, F.lit(1))

    return df.withColumns({name: bucket(key, name) for name, key in keys.items()})
