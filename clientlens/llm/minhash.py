"""Near-duplicate documents by an inverted join over the coordinates of MinHash signatures.

A signature has ``COORDINATES`` coordinates, each the hash of ``ROWS`` minima. Two texts of
Jaccard similarity ``s`` agree in a coordinate with probability ``s ** ROWS``. From that,
:func:`match_threshold` takes the largest number of agreeing coordinates that a pair at the
threshold misses with a probability of ``MISS`` at most. Pairs are found, counted and confirmed:

1. Texts with equal shingle sets become one class (``rep``, its smallest id).
2. *Prefix.* Two signatures that agree in ``t`` of ``n`` coordinates agree in one of the first
   ``n - t + 1``, so only these are posted under their (coordinate, value).
3. *Skip.* Posting lists of one class make no pair. A long list makes a star: each member with the
   one that shares most with others, so copies of a text make as many pairs as there are copies, not their square.
   After the components of the confirmed pairs are known, lists inside one component are skipped;
   in the others only pairs between components are made, from the members outside the list's
   largest component. So every pair that may be the only link between two components is looked at,
   but for those that :func:`most_in_common` rules out: shingles that no other document in an open
   list has can't be in an intersection, nor those of a common centre that one of the two lacks,
   and the rest may be too small for the threshold.
4. Pairs that agree in fewer coordinates than the threshold on the whole signatures are dropped;
   the rest is confirmed on full shingle sets, made again from the texts.

Confirming deals a pivot's members to salted groups of about ``MEMBERS_A_GROUP``; a task reads the
pivot's text first and then streams the members, so no group is held in memory.

Defined results: NULL or empty texts and texts without words have no shingles and stay alone. A row
without id stays alone: its component is NULL and it is kept. Rows with the same id are one document
with several texts, and linked by any of them. No rows give no rows; further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, in_slices, materialise, strings
from .components import components
from .shingles import MIX, mixed, shingle_sets, similar

COORDINATES = 32
ROWS = 3
MISS = 1e-9
MEMBERS_A_GROUP = 256
#: Bits for the shingles of a centre that a member lacks.
BITS = 256
FACTS = ("size", "room", "shared", "centre", "whole", "common", "lacks")
SKETCH = "doc_id long, n_shingles long, print binary, coordinates array<long>"


def match_threshold(percent: int, coordinates: int = COORDINATES, rows: int = ROWS) -> int:
    """Coordinates that must agree; at least 1."""
    agree = (percent / 100) ** rows
    missed = 0.0
    for t in range(coordinates + 1):
        missed += comb(coordinates, t) * agree**t * (1 - agree) ** (coordinates - t)
        if missed > MISS:
            return max(t, 1)
    return coordinates


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Coordinates of each set (none may be empty), one row a set; the number of a coordinate is
    mixed into its value."""
    values = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    steps = np.arange(1, COORDINATES * ROWS + 1, dtype=np.uint64)
    factors, shifts = mixed(steps * MIX[0]) | np.uint64(1), mixed(steps * MIX[1])
    found = np.empty((len(sets), COORDINATES), np.uint64)
    for c in range(COORDINATES):
        value = np.full(len(sets), c + 1, np.uint64) * MIX[0]
        for p in range(c * ROWS, c * ROWS + ROWS):
            value = mixed(value ^ np.minimum.reduceat(values * factors[p] + shifts[p], starts))
        found[:, c] = value
    return found.view(np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """Set size, fingerprint of the set and signature of each document."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = strings(batch)
            for low, high in in_slices(texts, 1 << 20):
                sets = list(shingle_sets(texts.slice(low, high - low), width))
                sizes = np.array([len(s) for s in sets], np.int64)
                some = sizes > 0
                coordinates = signatures([s for s in sets if len(s)]).ravel() if some.any() else np.empty(0, np.int64)
                ends = np.concatenate([[0], np.cumsum(some * COORDINATES)]).astype(np.int32)
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        sizes,
                        pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(ends, coordinates),
                    ],
                    names=["doc_id", "n_shingles", "print", "coordinates"],
                )

    return materialise(documents(docs).mapInArrow(sketch, SKETCH), "sketches")


def _beside(pairs: DataFrame, texts: DataFrame, width: int, each: Callable, names: list[str]) -> DataFrame:
    """``each(a, sets of a, b, set of b)`` for all pairs; gives arrays of the columns ``names``.

    ``texts`` has the different texts of each id in ``pairs``: ``rep``, ``text``. A pivot ``a`` is
    read once for each salted group of its members ``b``, before them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pivots = None, []
        for batch in batches:
            texts = strings(batch)
            keys = list(zip(batch.column("a").to_pylist(), batch.column("salt").to_pylist()))
            members = batch.column("b").to_pylist()
            for low, high in in_slices(texts, 1 << 20):
                found = []
                for i, own in enumerate(shingle_sets(texts.slice(low, high - low), width), low):
                    if group != keys[i]:
                        group, pivots = keys[i], []
                    if members[i] is None:
                        pivots.append(own)
                    else:
                        found.append(each(keys[i][0], pivots, members[i], own))
                columns = [np.concatenate(c).astype(np.int64) for c in zip(*found)]
                if columns and len(columns[0]):
                    yield pa.record_batch(columns, names=names)

    groups = pairs.groupBy("a").agg(F.ceil(F.count("b") / MEMBERS_A_GROUP).alias("groups"))
    salted = pairs.join(groups, "a").select("a", "b", F.pmod(F.xxhash64("b"), "groups").alias("salt"))
    members = salted.join(texts.withColumnRenamed("rep", "b"), "b").select("a", "salt", "b", "text")
    pivots = salted.select("a", "salt").distinct().join(texts.withColumnRenamed("rep", "a"), "a")
    rows = members.unionByName(pivots.select("a", "salt", F.lit(None).cast("long").alias("b"), "text"))
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return ordered.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (``a`` pivot, ``b`` member) whose full shingle sets are similar enough."""

    def each(a: int, pivots: list[np.ndarray], b: int, own: np.ndarray) -> tuple[list[int], list[int]]:
        same = any(similar(pivot, own, percent) for pivot in pivots)
        return ([a], [b]) if same else ([], [])

    return _beside(pairs, texts, width, each, ["a", "b"])


def overlaps(members: DataFrame, tried: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """What is known of the ``members`` of open lists without comparing them with each other:

    * ``alone``: how many of its shingles no other member has. A member whose star's centre is known
      lists only the shingles that its centre hasn't got, and centres list all of theirs, so each
      shingle of a member is listed by it or by its centre. What is listed once is one document's
      own. Centres count none, as their members don't list what they share with them.
    * ``centre``, ``whole``, ``common``: its centre, the size of the centre's set, and how much of it
      the member has; NULL for centres, and for documents of several texts.
    * ``lacks``: ``BITS`` bits of the centre's shingles that it hasn't got, by their hash.
    """
    starred = tried.join(members.withColumnRenamed("rep", "b"), "b", "left_semi").groupBy("b").agg(F.max_by("a", F.struct("weight", "a")).alias("a"))
    centres = starred.select(F.col("a").alias("rep")).distinct()
    leaves = materialise(starred.join(centres.withColumnRenamed("rep", "b"), "b", "left_anti").select("a", "b"), "leaves")
    words = [f"w{i}" for i in range(BITS // 64)]

    def each(a: int, pivots: list[np.ndarray], b: int, own: np.ndarray) -> list[np.ndarray]:
        added = own
        for pivot in pivots:
            added = np.setdiff1d(added, pivot, assume_unique=True)
        rows = np.zeros((len(added) + 1, 5 + len(words)), np.int64)
        rows[:, 0] = b
        rows[:-1, 2] = added.view(np.int64)
        lacking = np.setdiff1d(pivots[0], own, assume_unique=True)
        bits = np.zeros(BITS, bool)
        bits[(lacking % np.uint64(BITS)).astype(np.int64)] = True
        rows[-1, 1:5] = 1, a if len(pivots) == 1 else -1, len(pivots[0]), len(pivots[0]) - len(lacking)
        rows[-1, 5:] = np.packbits(bits, bitorder="little").view("<i8")
        return list(rows.T)

    def list_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, rows = batch.column("rep").to_numpy(), strings(batch)
            for low, high in in_slices(rows, 1 << 20):
                sets = list(shingle_sets(rows.slice(low, high - low), width))
                owner = np.repeat(reps[low:high], [len(s) for s in sets])
                yield pa.record_batch([owner, np.concatenate(sets).view(np.int64)], names=["rep", "shingle"])

    beside = materialise(_beside(leaves, texts, width, each, ["rep", "kind", "first", "whole", "common", *words]), "beside")
    whole = members.union(centres).distinct().join(leaves.select(F.col("b").alias("rep")), "rep", "left_anti")
    listed = texts.join(whole, "rep").select("rep", "text").mapInArrow(list_all, "rep long, shingle long")
    listed = listed.union(beside.filter("kind = 0").select("rep", "first"))
    own = listed.groupBy("shingle").agg(F.min("rep").alias("rep"), F.max("rep").alias("last")).filter("rep = last")
    alone = own.groupBy("rep").agg(F.count(F.lit(1)).alias("alone")).join(centres, "rep", "left_anti")
    facts = beside.filter("kind = 1").groupBy("rep").agg(
        F.count(F.lit(1)).alias("texts"), F.max("first").alias("centre"), F.max("whole").alias("whole"), F.max("common").alias("common"), F.array(*(F.max(w) for w in words)).alias("lacks")
    )
    single = (F.col("texts") == 1) & (F.col("centre") >= 0)
    facts = facts.select("rep", *(F.when(single, F.col(c)).alias(c) for c in ("centre", "whole", "common", "lacks")))
    return members.join(alone, "rep", "left").join(facts, "rep", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))


def most_in_common(x: str, y: str) -> Column:
    """No intersection of the members ``x`` and ``y`` (prefixes of columns) is larger. Of shingles of
    the same centre, they share at most those that neither lacks; of others, those that are not
    one's own."""
    c = lambda name: (F.col(x + name), F.col(y + name))
    lacks = F.zip_with(*c("lacks"), lambda a, b: F.bit_count(a.bitwiseOR(b)))
    lacking = F.aggregate(lacks, F.lit(0), lambda a, b: a + b)
    whole = F.col(x + "whole")
    of_centre = whole - F.greatest(lacking.cast("long"), whole - F.least(*c("common")))
    same = F.when(F.col(x + "centre") == F.col(y + "centre"), of_centre + F.least(*c("shared")))
    return F.least(*c("room"), same)


def _agreeing(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """The pairs whose whole signatures agree in ``least`` coordinates."""
    own = classes.select("rep", "coordinates")
    both = pairs.join(own.toDF("a", "of_a"), "a").join(own.toDF("b", "of_b"), "b")
    agree = F.size(F.filter(F.zip_with("of_a", "of_b", lambda x, y: x == y), lambda same: same))
    return both.filter(agree >= least).select(pairs.columns)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each row.

    Texts are linked with 100 * intersection >= ``percent`` * union of their shingles of ``width``
    words; a component's id is the smallest id in it, whose row is kept.
    """
    least = match_threshold(percent)
    sketched = sketches(docs, width)
    classes = (
        sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("print")
        .agg(
            F.min("doc_id").alias("rep"),
            F.min("n_shingles").alias("n_shingles"),
            F.min_by("coordinates", "doc_id").alias("coordinates"),
        )
    )
    classes = materialise(classes, "classes")
    prefix = F.slice("coordinates", 1, COORDINATES - least + 1)
    posted = classes.select("rep", F.explode(prefix).alias("value"))
    lengths = posted.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialise(posted.join(lengths, "value"), "shared")
    # The centre of a list is its member that shares most with others: of copies that were changed
    # here and there, the one that was changed least.
    weights = shared.groupBy("rep").agg(F.sum("n").alias("weight"))
    weighed = shared.join(weights, "rep").select("value", "rep", "weight")
    first = F.max(F.struct("weight", (-F.col("rep")).alias("minus")))
    centres = weighed.groupBy("value").agg(first.alias("c")).select("value", (-F.col("c.minus")).alias("a"), "c.weight")
    posted = materialise(shared.select("value", "rep").join(centres, "value"), "posted")

    # The texts of all documents that share a coordinate with another one, once.
    texts = documents(docs).withColumnRenamed("doc_id", "rep").join(posted.select("rep").distinct(), "rep", "left_semi")
    texts = materialise(texts.withColumn("key", F.xxhash64("text")).dropDuplicates(["rep", "key"]).drop("key"), "texts")

    tried = posted.filter("a <> rep").groupBy("a", F.col("rep").alias("b")).agg(F.max("weight").alias("weight"))
    tried = materialise(_agreeing(tried, classes, least), "pairs")
    links = materialise(confirmed(tried, texts, width, percent), "linked")
    roots = components(links)
    placed = posted.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "value", "rep", F.coalesce("root", "rep").alias("root")
    )
    sizes = placed.groupBy("value", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("value").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    open_lists = materialise(placed.join(largest.filter("roots > 1"), "value").drop("roots"), "open")
    members = materialise(open_lists.select("rep").distinct(), "members")
    sizes = classes.groupBy("rep").agg(F.max("n_shingles").alias("size"), F.min("n_shingles").alias("least"))
    single = F.col("size") == F.col("least")
    facts = (
        overlaps(members, tried, texts, width)
        .join(sizes, "rep")
        # What a document can have in common with another one at most.
        .withColumn("room", F.when(single, F.col("size") - F.col("alone")).otherwise(F.col("size")))
        .withColumn("shared", F.col("room") - F.col("common"))
        .withColumn("centre", F.when(single, F.col("centre")))
        .filter(F.col("room") * 100 >= F.col("size") * percent)
        .select("rep", *FACTS)
    )
    open_lists = materialise(open_lists.join(materialise(facts, "facts"), "rep"), "open")
    outside = open_lists.filter("root <> main").select("value", *(F.col(c).alias(f"x_{c}") for c in ("rep", "root", *FACTS)))
    both = most_in_common("x_", "")
    across = (
        outside.join(open_lists, "value")
        .filter("root <> x_root AND (root = main OR x_rep < rep)")
        .filter(both * 100 >= (F.col("size") + F.col("x_size") - both) * percent)
        .select(F.least("x_rep", "rep").alias("a"), F.greatest("x_rep", "rep").alias("b"))
        .distinct()
        .join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    )
    across = materialise(_agreeing(across, classes, least), "pairs")
    more = materialise(confirmed(across, texts, width, percent), "linked")
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    by_print = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "print", F.coalesce("root", "rep").alias("root")
    )
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return (
        sketched.select("doc_id", "n_shingles", "print")
        .join(by_print, "print", "left")
        .select(
            "doc_id",
            "n_shingles",
            found.alias("component_id"),
            F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept"),
        )
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, and of several rows
    with that id the one whose text has the smallest hash. Rows without id all stay."""
    kept = near_duplicates(docs, width, percent).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    rows = docs.select("doc_id", F.struct("*").alias("row"), F.xxhash64("text").alias("hash")).join(kept, "doc_id", "left_semi")
    first = Window.partitionBy("doc_id").orderBy("hash", F.col("row.text"))
    found = rows.withColumn("nth", F.row_number().over(first)).filter("nth = 1").select("row.*")
    return found.unionByName(docs.filter("doc_id IS NULL"))
