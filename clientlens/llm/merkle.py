"""Merkle manifest of a dataset: a tree of digests, and a proof for every row.

A leaf is the digest of a row. The leaves of a source, in ascending order of id, are the leaves of a
tree in which ``FAN`` nodes in a row have one parent; the roots of all sources, in order of source,
are the leaves of another such tree, whose root stands for the dataset. H is the hexadecimal SHA-256 of
its inputs, one after the other. While a level has more than one node, each run of ``FAN`` (the last
may be shorter, one node too) becomes its H. The proof of a leaf is, level by level, the digests in
its run to the left and to the right.

Trees are built by time-forward processing. Nodes are labelled by tree, block, level and place, and
swept in this order; a node sends its digest to its parent, whose label is larger, through a priority
queue ordered by label. The queue is external. Messages within a block, ``FAN`` to the power of
``LEVELS`` leaves, wait in the heap of the task that sweeps it; messages that leave it are rows of a
written table, which Spark's shuffle and sort bring to their parents in the next sweep. Each sweep
leaves one row of 256, and a block is small, so a source with a third of all rows is spread evenly.
The reversed sweep goes from the root back: a table of parents' proofs and the nodes below them are
sorted by label together, a block's parent ahead of its nodes, and a heap of reversed labels delivers
the rest of the proof to the children.

No text is shuffled: leaves are hashed where they are read, and 64 characters go on.

Defined results: a NULL value has the mark ``-`` in its leaf; NULL sources are a tree of their own,
ahead of others; within a source NULL ids come first and equal ids are ordered by their leaves;
equal rows are a leaf each; an empty table has no rows, and no root; a table of one row has its leaf
as subroot and root, with an empty proof; further columns are left out.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

FAN = 16
#: Levels that one sweep adds; a block has FAN ** LEVELS nodes.
LEVELS = 2
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PROOF = "array<struct<before: string, after: string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    """The leaf of a row with this text."""
    return F.sha2(F.concat(*(_field(text if name == "text" else F.col(name)) for name in FIELDS)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``leaf`` and ``tampered``, the leaf of the row with its text's A-Z in
    lower case for ids whose unsigned CRC-32 5 divides; NULL for others."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    text = F.col("text").cast("string")
    # Where all is ASCII, lower() does the same as translate(), in a tenth of the time.
    small = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf_of(text).alias("leaf"),
        F.when(chosen, leaf_of(small)).alias("tampered"),
    )


def ranked(nodes: DataFrame, tree: str, *order: Column) -> DataFrame:
    """Nodes with ``place``, their place in their tree from 0, and ``n``, the nodes of the tree.

    They are sorted by ranges over all tasks. A tree may go through many of them, so its rows are
    counted for each range, and the counts of the ranges before give the first place of each.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(tree).asc_nulls_first(), *order]
    ranged = nodes.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = materialise(ranged.select("*", F.spark_partition_id().alias("range"), in_range.alias("at")), "ranged")
    spans = ranged.groupBy("range", F.col(tree).alias("of")).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    all_of_it = Window.partitionBy("of")
    spans = spans.select(
        F.col("range").alias("of_range"),
        "of",
        "first",
        (F.sum("rows").over(all_of_it.orderBy("range")) - F.col("rows")).alias("ahead"),
        F.sum("rows").over(all_of_it).alias("n"),
    )
    same = (F.col("range") == F.col("of_range")) & F.col(tree).eqNullSafe(F.col("of"))
    placed = ranged.join(spans, same).withColumn("place", F.col("at") - F.col("first") + F.col("ahead"))
    return placed.drop("range", "at", "of_range", "of", "first", "ahead")


class Block:
    """The nodes of one block by time-forward processing: ``levels`` has the digests of each level."""

    def __init__(self, first: int, n: int, digests: list[str]) -> None:
        """``first`` is the place of the block's first node, ``n`` the nodes of the whole tree."""
        self.first = first
        self.levels = [digests]
        # Labels are (level, place). A node's message carries its own label, so a parent gets its
        # children's digests in their order.
        queue = [((1, (first + i) // FAN), first + i, d) for i, d in enumerate(digests)] if n > 1 else []
        heapq.heapify(queue)
        while queue:
            level, place = parent = queue[0][0]
            received = []
            while queue and queue[0][0] == parent:
                received.append(heapq.heappop(queue)[2])
            if level == len(self.levels):
                self.levels.append([])
                n = -(-n // FAN)
            made = digest("".join(received))
            self.levels[level].append(made)
            if level < LEVELS and n > 1:
                heapq.heappush(queue, ((level + 1, place // FAN), place, made))

    def proofs(self, above: list) -> Iterator[list]:
        """The proof of each leaf; ``above`` is the proof of the block's root. Labels are reversed:
        parents come before children, who get the rest of their proof from them."""
        top = len(self.levels) - 1
        queue = [((-top, self.first // FAN**top), above)]
        while queue:
            (level, place), proof = heapq.heappop(queue)
            if not level:
                yield proof
                continue
            below = self.levels[-level - 1]
            start = self.first // FAN ** (-level - 1)
            low = place * FAN - start
            run = below[low : low + FAN]
            for i in range(len(run)):
                step = ("".join(run[:i]), "".join(run[i + 1 :]))
                heapq.heappush(queue, ((level + 1, place * FAN + i), [step, *proof]))


def _blocks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """The rows of each block of a sorted stream: the values of ``columns``."""
    label, rows = None, []
    for batch in batches:
        values = zip(*(batch.column(c).to_pylist() for c in ("tree", "block", *columns)))
        for tree, block, *row in values:
            if (tree, block) != label:
                if rows:
                    yield label, rows
                label, rows = (tree, block), []
            rows.append(row)
    if rows:
        yield label, rows


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The root of each block."""
    for batch in _gathered(
        ((tree, block, Block(rows[0][0], rows[0][1], [r[2] for r in rows]).levels[-1][0], -(-rows[0][1] // BLOCK)))
        for (tree, block), rows in _blocks(batches, ("place", "n", "digest"))
    ):
        yield pa.record_batch([pa.array(c, t) for c, t in zip(batch, (pa.string(), pa.int64(), pa.string(), pa.int64()))], names=["tree", "place", "digest", "n"])


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The proof of each node, from that of its block's root, which comes first."""
    step = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def rows() -> Iterator[tuple]:
        for (tree, _), (head, *nodes) in _blocks(batches, ("place", "n", "digest", "proof", "row", "subroot")):
            above = [(p["before"], p["after"]) for p in head[3]]
            block = Block(nodes[0][0], nodes[0][1], [node[2] for node in nodes])
            for node, proof in zip(nodes, block.proofs(above)):
                yield tree, node[0], proof, node[4], head[5]

    for tree, place, proof, row, subroot in _gathered(rows()):
        # Steps are tuples in Python; Arrow builds the two text columns from flat lists.
        ends = [0]
        for p in proof:
            ends.append(ends[-1] + len(p))
        sides = [pa.array([s[k] for p in proof for s in p], pa.string()) for k in (0, 1)]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(sides, fields=list(step.value_type)))
        yield pa.record_batch(
            [pa.array(tree, pa.string()), pa.array(place, pa.int64()), lists, pa.array(row, ROW), pa.array(subroot, pa.string())],
            names=["tree", "place", "proof", "row", "subroot"],
        )


#: What a leaf keeps besides its digest.
ROW = pa.struct([("doc_id", pa.int64()), ("tampered", pa.string()), ("leaf", pa.string())])
ROW_SQL = "struct<doc_id: long, tampered: string, leaf: string>"


def _gathered(rows: Iterator[tuple], many: int = 2048) -> Iterator[list[tuple]]:
    """Rows as columns, ``many`` at a time."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == many:
            yield list(zip(*held))
            held = []
    if held:
        yield list(zip(*held))


def _swept(nodes: DataFrame, step, schema: str, *order: str) -> DataFrame:
    """Nodes dealt by block and swept in the order of their labels."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return nodes.repartition(parts, "tree", "block").sortWithinPartitions("tree", "block", *order).mapInArrow(step, schema)


def forest(nodes: DataFrame) -> list[DataFrame]:
    """All rounds of nodes, each with the roots of the blocks of the round before; the last has one
    row for each tree. ``nodes`` has ``tree``, ``place``, ``n`` and ``digest``."""
    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        blocks = rounds[-1].select("tree", F.expr(f"place div {BLOCK}").alias("block"), "place", "n", "digest")
        rounds.append(materialise(_swept(blocks, _up, "tree string, place long, digest string, n long", "place"), "nodes"))
        most = -(-most // BLOCK)
    return rounds


def proofs(rounds: list[DataFrame], roots: DataFrame) -> DataFrame:
    """The proof of every leaf of a forest: ``tree``, ``place``, ``row``, ``proof`` and ``subroot``, the
    root of its tree. ``roots`` has ``tree``, ``subroot`` and the ``proof`` of each tree's root; the
    first of ``rounds`` has ``row``, what leaves keep."""
    above = roots.select("tree", F.lit(0).cast("long").alias("place"), "proof", "subroot")
    nothing = F.lit(None).cast(ROW_SQL).alias("row")
    for i, nodes in reversed(list(enumerate(rounds[:-1]))):
        heads = above.select(
            "tree", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), F.lit(0).cast("long").alias("n"),
            F.lit("").alias("digest"), "proof", nothing, "subroot",
        )
        below = nodes.select(
            "tree", F.expr(f"place div {BLOCK}").alias("block"), "place", "n", "digest", F.lit(None).cast(PROOF).alias("proof"),
            "row" if "row" in nodes.columns else nothing, F.lit(None).cast("string").alias("subroot"),
        )
        schema = f"tree string, place long, proof {PROOF}, row {ROW_SQL}, subroot string"
        above = _swept(heads.unionByName(below), _down, schema, "place")
        if i:
            above = materialise(above, "proofs")
    if len(rounds) == 1:
        own = rounds[0].select("tree", "place", "row" if "row" in rounds[0].columns else nothing)
        above = own.join(above.drop("place"), "tree")
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """For each row ``doc_id``, ``leaf``, ``tampered``, ``subroot``, ``root`` and ``proof``: what stands
    to the left and right of its node on each level, from its own to below the root."""
    spark = docs.sparkSession
    # Ranges are drawn from a sample, so what is ranked is read twice: digests, not texts.
    digests = materialise(leaves(docs), "digests")
    placed = ranked(digests, "source", F.col("doc_id").asc_nulls_first(), F.col("leaf"))
    # NULL stays apart from every text: a tree's name begins with a mark.
    tree = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit(":"), "source"))
    kept = F.struct("doc_id", "tampered", "leaf").cast(ROW_SQL)
    nodes = materialise(placed.select(tree.alias("tree"), "place", "n", F.col("leaf").alias("digest"), kept.alias("row")), "leaves")
    rounds = forest(nodes)
    # Roots of sources with few rows stay as they are while others are built further.
    subroots = ranked(rounds[-1].select(F.lit("all").alias("whole"), "tree", "digest"), "whole", F.col("tree") != "-", F.col("tree"))
    subroots = materialise(subroots.select(F.col("whole").alias("tree"), F.col("tree").alias("of"), "place", "n", "digest"), "subroots")
    upper = forest(subroots.drop("of"))
    root = upper[-1].select(F.col("digest").alias("root"))
    found = root.first()
    if found is None:
        return spark.createDataFrame([], f"doc_id long, leaf string, tampered string, subroot string, root string, proof {PROOF}")
    top = F.array().cast(PROOF)
    whole = proofs(upper, spark.range(1).select(F.lit("all").alias("tree"), F.lit(found.root).alias("subroot"), top.alias("proof")))
    roots = subroots.join(whole.select("place", "proof"), "place").select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), "proof")
    proven = proofs(rounds, materialise(roots, "roots"))
    return proven.select("row.doc_id", "row.leaf", "row.tampered", "subroot", F.lit(found.root).alias("root"), "proof")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step.before, node, step.after), 256))


def proof_digest(proof: Column) -> Column:
    """H of all siblings of a proof."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step.before, step.after)), ""), 256)
