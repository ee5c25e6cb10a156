"""Near-duplicate vectors by tiles of 8-bit products with error bounds.

Vectors are compared within a label. Each is scaled to length 1 and rounded to steps of its own
largest component over 127, so a component is off by at most half a step and the vector by at most
``e``, the length of what the rounding left, which is measured. For two vectors the product of the
whole numbers, times both steps, differs from the cosine by ``e_x + e_y + e_x * e_y`` at most. Only
pairs whose product plus that bound reaches the threshold are computed again in double precision;
no pair at the threshold can be lost. The integer products are done in floating point numbers that
hold them exactly.

Equal vectors become one *class* with a count. The classes of a label are dealt to blocks of about
``BLOCK``; a task gets a pair of blocks, and gives for each class the sum of counts it is linked with
and a spanning forest of the links, so pairs are never written. The number of pairs of blocks grows
with the square of a label's different vectors, as comparing all rows must; a hot label is spread over
as many tasks as it has pairs of blocks.

Defined results: vectors that are NULL, empty, zero, or hold NULL or a non-finite component, and rows
without label, link with nothing; lengths other than the label's most linked only to equal lengths;
rows without id stay alone with component NULL and are kept; repeated rows are vectors of their own,
usable rows with the same id are one node of the components, also across labels; no rows give no rows;
further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .components import components

BLOCK = 4096
TILE = 1024
PARTIAL = "kind int, a long, b long"
#: Products of this many components of 8 bits are exact in 32-bit floating point numbers.
EXACT = 1024


def classes_of(vectors: DataFrame) -> DataFrame:
    """Usable rows by equal vector: ``label``, ``size``, ``vector``, ``rep`` (smallest id), ``n``."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    fine = "label IS NOT NULL AND vec_id IS NOT NULL AND size(vector) > 0 AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) AND exists(vector, x -> x <> 0)"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), doubles.alias("vector"))
    # 0.0 and -0.0 are one value.
    rows = rows.filter(fine).withColumn("vector", F.transform("vector", lambda x: x + 0.0))
    return rows.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")).withColumn("size", F.size("vector"))


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first to a largest component of 1, so that squares can't overflow."""
    scaled = matrix / np.abs(matrix).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers of 8 bits, the step of each row, and a bound of what rounding left of it."""
    step = np.abs(units).max(1) / 127
    whole = np.rint(units / step[:, None]).astype(np.int8)
    left = units - whole * step[:, None]
    return whole, step, np.sqrt((left * left).sum(1)) * (1 + 1e-9) + 1e-12


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of rows of whole numbers of 8 bits."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT):
        total += a[:, at : at + EXACT].astype("f4") @ b[:, at : at + EXACT].astype("f4").T
    return total


class Forest:
    """Spanning links of one task's classes."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def top(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = int(self.root[i])
        return i

    def add(self, rows: np.ndarray, columns: np.ndarray) -> None:
        tops = self.flat()
        new = tops[rows] != tops[columns]
        for i, j in zip(rows[new].tolist(), columns[new].tolist()):
            x, y = self.top(i), self.top(j)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.links.append((i, j))

    def flat(self) -> np.ndarray:
        root = self.root
        while (root[root] != root).any():
            root = root[root]
        self.root = root
        return root


def links_of(matrix: np.ndarray, n: np.ndarray, split: int, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links between the rows before and after ``split``, or among all rows if it is 0: for each row
    the sum of ``n`` over the rows it is linked with, and spanning links."""
    units = unit(matrix)
    whole, step, off = quantised(units)
    linked, forest = np.zeros(len(n), np.int64), Forest(len(n))
    last = split or len(n)
    for i in range(0, last, TILE):
        x = slice(i, min(i + TILE, last))
        for j in range(split or i, len(n), TILE):
            y = slice(j, min(j + TILE, len(n)))
            nearly = products(whole[x], whole[y]) * step[x, None] * step[None, y]
            bound = off[x, None] + off[None, y] + off[x, None] * off[None, y]
            rows, columns = np.nonzero(nearly + bound >= threshold)
            rows, columns = rows + x.start, columns + y.start
            if not split:
                upper = rows < columns
                rows, columns = rows[upper], columns[upper]
            sure = np.empty(len(rows), bool)
            for k in range(0, len(rows), 1 << 15):
                r, c = rows[k : k + (1 << 15)], columns[k : k + (1 << 15)]
                sure[k : k + (1 << 15)] = np.einsum("ij,ij->i", units[r], units[c]) >= threshold
            rows, columns = rows[sure], columns[sure]
            linked += np.bincount(rows, n[columns], len(n)).astype(np.int64) + np.bincount(columns, n[rows], len(n)).astype(np.int64)
            forest.add(rows, columns)
    return linked, forest.links


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of each row of ``vec_id``,
    ``embedding`` and ``label``."""
    # A class has a number of its own: an id with several vectors may be the smallest of several classes.
    classes = materialise(classes_of(vectors).withColumn("class", F.monotonically_increasing_id()), "classes")
    groups = classes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("m"))
    # Classes of a label and size go to blocks by a hash; a block is about BLOCK classes.
    blocked = classes.join(groups.withColumn("blocks", F.ceil(F.col("m") / BLOCK)), ["label", "size"]).select(
        "label", "size", "class", "n", "vector", "blocks", F.pmod(F.xxhash64("class"), "blocks").alias("block")
    )
    # Each block meets itself and every later one.
    met = F.expr("""
        explode(transform(sequence(0L, blocks - 1), other -> struct(least(block, other) AS low, greatest(block, other) AS high)))
    """)
    met_by = blocked.select("label", "size", "block", "class", "n", "vector", met.alias("met"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = rows["met"].iloc[0]["low"], rows["met"].iloc[0]["high"]
        rows = rows.sort_values(["block", "class"], kind="stable")
        numbers, n = rows["class"].to_numpy(), rows["n"].to_numpy()
        split = int((rows["block"] == low).sum()) if low != high else 0
        if low != high and split == len(rows):
            return pd.DataFrame({"kind": [], "a": [], "b": []})
        linked, links = links_of(np.stack(rows["vector"].to_numpy()), n, split, threshold)
        some = linked > 0
        a, b = (numbers[[x[k] for x in links]] if links else np.empty(0, np.int64) for k in (0, 1))
        return pd.DataFrame({
            "kind": np.repeat([0, 1], [some.sum(), len(a)]),
            "a": np.concatenate([numbers[some], a]),
            "b": np.concatenate([linked[some], b]),
        })

    found = materialise(met_by.groupBy("label", "size", "met").applyInPandas(compare, PARTIAL), "links")
    own = F.transform("embedding", lambda x: x.cast("double") + 0.0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", own.alias("vector"))
    placed = rows.join(classes.select("label", "vector", "class"), ["label", "vector"], "left").select("vec_id", "class")
    placed = materialise(placed, "placed")
    # An id with several vectors ties their classes together.
    spans = placed.filter("vec_id IS NOT NULL AND class IS NOT NULL").groupBy("vec_id").agg(F.min("class").alias("a"), F.max("class").alias("last"))
    several = spans.filter("a < last").select("vec_id", "a")
    ties = placed.join(several, "vec_id").filter("class <> a").select("a", F.col("class").alias("b")).distinct()
    roots = components(found.filter("kind = 1").select("a", "b").unionByName(ties)).withColumnRenamed("node", "class")
    linked = found.filter("kind = 0").groupBy(F.col("a").alias("class")).agg(F.sum("b").alias("linked"))
    rooted = (
        classes.select("class", "rep", "n")
        .join(linked, "class", "left")
        .join(roots, "class", "left")
        .select("class", "rep", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "class").alias("root"))
    )
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("smallest"))
    by_class = rooted.join(smallest, "root").select("class", "n_links", "smallest")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("smallest", "vec_id"))
    return placed.join(by_class, "class", "left").select(
        "vec_id",
        F.when(F.col("vec_id").isNotNull() & F.col("n_links").isNotNull(), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
