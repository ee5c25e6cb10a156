"""Ranked lexical search over an index that is partitioned by terms, as a pipeline of term owners.

The index is written once, without a shuffle of texts. Each task takes its documents in blocks (at
most ``BLOCK_DOCS`` documents and about 8 MB of text) and writes a row for each term of a block: the
places of the documents in the block and the occurrences there. One more row has the ids and lengths
of the block's documents. Document frequencies, the number of documents and of their terms are sums over
these rows.

Items are searched in bundles of ``BUNDLE`` items, each with the lists of all its terms. Term owners
are stages: the first owns the terms that few documents hold, the last those that many do, so the
accumulators stay sparse for as long as they can. A bundle goes through the stages in turn. It
carries, for each block, sparse accumulators (item, document, score so far); a stage cogroups them
with its owner's lists for that block, and adds weight * occurrences of the item * share of the
document, all of them integers. After the last stage each block gives the best of its documents for
each item, and a ranking over blocks the final ones.

An accumulator goes early only when it provably can't matter: the scores so far are lower bounds, as no
contribution is negative, and the weights of the terms to come bound what a document can still get.
A document that can't reach the block's ``best``-th lower bound isn't among the block's best, so
not among the final ones. Ties are kept. There is no limit on documents, terms, lists or items.

A list of a frequent term has one row for each block, and a group is one block of one bundle, so no term
and no item gathers more than that in a task.

Defined results: NULL text has no terms; documents and items without terms are found by none and find
none; rows of documents with equal or NULL id are documents of their own (NULL ids last among equal
scores); equal benchmark rows are one item, different texts with the same id (or without) are items of
their own, each with ranks from 1; empty tables give no rows; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, in_slices, materialise, strings

BLOCK_DOCS = 4096
BUNDLE = 128
#: An owner's terms are held by at most one document in so many; the last owner has the rest.
OWNERS = (64, 8, 1)
#: Rows of the terms of all items up to which they are broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 200_000
#: Parts that the lists of a term are dealt to when they are shuffled.
SALTS = 32
#: What a document's share in a term is below: 10 ** 9 * tf div (1000 * tf + 8 * m) < 10 ** 6.
MOST = 1_000_000
INDEX = "block long, term string, docs binary, counts binary, ids binary, known binary"
STATE = "bundle long, block long, ids binary, known binary, shares binary, rests binary, places binary, scores binary"

_KINDS = np.full(256, 0x20, np.uint8)
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _KINDS[_low:_high] = np.arange(_low, _high)
_KINDS[0x41:0x5B] += 0x20


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For every term of the texts its text and its code, and the terms by code. Letters A-Z count as
    a-z; other characters of ASCII but letters and digits stand between terms."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.empty(0, np.uint8)
    moved = pa.py_buffer(np.ascontiguousarray(offsets - offsets[0]) if len(texts) else np.zeros(1, np.int64))
    mapped = pa.Array.from_buffers(pa.large_string(), len(texts), [None, moved, pa.py_buffer(_KINDS[raw])])
    split = pc.ascii_split_whitespace(mapped)
    bounds = split.offsets.to_numpy()
    of_text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if empty >= 0:
        real = codes != empty
        of_text, codes = of_text[real], codes[real]
    return of_text, codes, coded.dictionary


def _lists(keys: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Sorted keys (code, text) as codes, and for each the binary lists of texts and of counts."""
    codes, texts = np.divmod(keys, width)
    starts = np.flatnonzero(np.diff(codes, prepend=-1))
    ends = np.append(starts, len(codes))

    def packed(values: np.ndarray) -> pa.Array:
        at = pa.py_buffer((ends * values.itemsize).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(starts), [None, at, pa.py_buffer(np.ascontiguousarray(values))])

    return codes[starts], packed(texts.astype("<u2")), packed(counts.astype("<u4"))


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    binary, many = pa.binary(), pa.schema([("block", pa.int64()), ("term", pa.string()), *((c, pa.binary()) for c in ("docs", "counts", "ids", "known"))])
    for batch in batches:
        texts, ids = strings(batch), batch.column("doc_id")
        for start, end in in_slices(texts):
            for low in range(start, end, BLOCK_DOCS):
                high = min(end, low + BLOCK_DOCS)
                width = high - low
                of_text, codes, terms = terms_of(texts.slice(low, width))
                lengths = np.bincount(of_text, minlength=width).astype("<i8")
                own = ids.slice(low, width)
                yield pa.record_batch(
                    [
                        pa.array([block]),
                        pa.array([None], pa.string()),
                        pa.array([None], binary),
                        pa.array([lengths.tobytes()], binary),
                        pa.array([pc.fill_null(own, 0).to_numpy().astype("<i8").tobytes()], binary),
                        pa.array([pc.is_valid(own).to_numpy(zero_copy_only=False).tobytes()], binary),
                    ],
                    schema=many,
                )
                if len(codes):
                    keys, counts = np.unique(codes.astype(np.int64) * width + of_text, return_counts=True)
                    held, docs, tfs = _lists(keys, counts, width)
                    names, none = terms.take(pa.array(held)).cast(pa.string()), pa.nulls(len(held), binary)
                    yield pa.record_batch([pa.array(np.full(len(held), block)), names, docs, tfs, none, none], schema=many)
                block += 1


def index(docs: DataFrame) -> DataFrame:
    """The written index: rows of terms, and for each block a row without term."""
    return materialise(documents(docs).mapInArrow(_indexed, INDEX), "index")


def items_of(benchmark: DataFrame) -> DataFrame:
    """``item``, a number for each item, ``item_id`` and ``terms``, the text in terms."""
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.filter(F.split(low, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda t: t != "")
    return rows.select(F.monotonically_increasing_id().alias("item"), "item_id", terms.alias("terms")).filter("size(terms) > 0")


def _numbered(items: DataFrame) -> DataFrame:
    """``item`` with its ``bundle`` and ``nth``, its place there. Items are dealt by hash to parts of
    about ``BUNDLE`` items; a larger part is more than one bundle."""
    parts = -(-items.count() // BUNDLE) or 1
    dealt = items.select("item", F.pmod(F.xxhash64("item"), F.lit(parts).cast("long")).alias("part"))
    dealt = dealt.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy("item")) - 1)
    return dealt.select(
        "item", (F.col("part") * 4096 + F.expr(f"at div {BUNDLE}")).alias("bundle"), F.expr(f"CAST(at % {BUNDLE} AS long)").alias("nth")
    )


def _weights(lists: DataFrame, n_docs: int) -> DataFrame:
    """``term``, ``weight`` and ``owner`` of each term that a document holds."""
    found = lists.groupBy("term").agg(F.sum(F.octet_length("docs") / 2).cast("long").alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double")))
    owner = F.lit(len(OWNERS) - 1)
    for i, share in reversed(list(enumerate(OWNERS[:-1]))):
        owner = F.when(F.col("df") * share <= n_docs, i).otherwise(owner)
    return found.select("term", weight.cast("long").alias("weight"), owner.alias("owner"))


def _matched(lists: DataFrame, wanted: DataFrame, rows: int) -> DataFrame:
    """Rows of lists with the rows of ``wanted`` of the same term."""
    if rows <= BROADCAST_ROWS:
        return lists.join(F.broadcast(wanted), "term")
    copies = wanted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    return lists.withColumn("salt", F.pmod("block", F.lit(SALTS).cast("long"))).join(copies, ["term", "salt"]).drop("salt")


def _stage(best: int, stage: int):
    """Adds an owner's lists to the accumulators of one bundle in one block."""

    last = stage == len(OWNERS) - 1

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _EMPTY[last]
        state = {c: left.column(c)[0].as_py() for c in left.column_names}
        shares = np.frombuffer(state["shares"], "<i8")
        n = len(shares)
        scores = np.zeros((BUNDLE, n), np.int64)
        scores.reshape(-1)[np.frombuffer(state["places"], "<u4")] = np.frombuffer(state["scores"], "<i8")
        rest = np.frombuffer(state["rests"], "<i8").reshape(len(OWNERS), BUNDLE)[stage]
        for docs, counts, nths, weights in zip(*(right.column(c).to_pylist() for c in ("docs", "counts", "nths", "weights"))):
            at, tf = np.frombuffer(docs, "<u2"), np.frombuffer(counts, "<u4").astype(np.int64)
            share = (1_000_000_000 * tf) // (1000 * tf + 8 * shares[at])
            for nth, weight in zip(nths, weights):
                scores[nth, at] += weight * share
        ids, known = np.frombuffer(state["ids"], "<i8"), np.frombuffer(state["known"], bool)
        alive = scores > 0
        if n > best:
            least = np.partition(scores, n - best, axis=1)[:, n - best, None]
            alive &= scores + rest[:, None] >= least
        nth, at = np.nonzero(alive)
        if last:
            return _best_rows(state["bundle"], nth, ids[at], known[at], scores[nth, at], best)
        places = (nth * n + at).astype("<u4")
        kept = [*(state[c] for c in ("bundle", "block", "ids", "known", "shares", "rests")), places.tobytes(), scores[nth, at].astype("<i8").tobytes()]
        return pa.table([pa.array([v], t) for v, t in zip(kept, _EMPTY[False].schema.types)], schema=_EMPTY[False].schema)

    return run


def _best_rows(bundle: int, nth: np.ndarray, ids: np.ndarray, known: np.ndarray, scores: np.ndarray, best: int) -> pa.Table:
    order = np.lexsort((ids, ~known, -scores, nth))
    nth, ids, known, scores = nth[order], ids[order], known[order], scores[order]
    first = np.flatnonzero(np.diff(nth, prepend=-1))
    rank = np.arange(len(nth)) - np.repeat(first, np.diff(np.append(first, len(nth))))
    top = rank < best
    return pa.table(
        [pa.array(np.full(int(top.sum()), bundle)), pa.array(nth[top]), pa.array(ids[top], mask=~known[top]), pa.array(scores[top])],
        schema=_EMPTY[True].schema,
    )


FOUND = "bundle long, nth long, doc_id long, score long"
_EMPTY = {
    False: pa.schema([("bundle", pa.int64()), ("block", pa.int64()), *((c, pa.binary()) for c in ("ids", "known", "shares", "rests", "places", "scores"))]).empty_table(),
    True: pa.schema([("bundle", pa.int64()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]).empty_table(),
}


def _shares(n_docs: int, n_terms: int):
    """The row of each block as the start of its accumulators: m of each document, no scores yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                lengths = np.frombuffer(row["counts"], "<i8")
                # Python's integers: 75 * n * N may pass 63 bits before it is divided.
                least = 25 + np.array([75 * x * n_docs // n_terms for x in lengths.tolist()], "<i8")
                kept = [row["bundle"], row["block"], row["ids"], row["known"], least.tobytes(), np.array(row["rests"], "<i8").tobytes(), b"", b""]
                yield pa.record_batch([pa.array([v], t) for v, t in zip(kept, _EMPTY[False].schema.types)], schema=_EMPTY[False].schema)

    return run


def search(docs: DataFrame, benchmark: DataFrame, best: int = 10) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's ``best`` documents."""
    return ranked(index(docs), benchmark, best)


def ranked(written: DataFrame, benchmark: DataFrame, best: int = 10) -> DataFrame:
    """The same over an index that is written already."""
    spark = written.sparkSession
    blocks, lists = written.filter("term IS NULL"), written.filter("term IS NOT NULL").select("block", "term", "docs", "counts")
    n_docs, n_terms = blocks.mapInArrow(_sizes, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    items = materialise(items_of(benchmark), "items")
    dealt = materialise(_numbered(items), "bundles")
    if not n_docs or dealt.isEmpty():
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    said = items.select("item", F.explode("terms").alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))
    said = materialise(said.join(dealt, "item"), "terms")
    rows = said.count()
    held = _matched(lists, said.select("term").distinct(), rows)
    weighted = materialise(said.join(_weights(held, n_docs), "term").select("*", (F.col("times") * F.col("weight")).alias("w")), "weights")
    by_bundle = weighted.groupBy("owner", "bundle", "term").agg(
        F.collect_list(F.struct("nth", "w")).alias("of")
    ).select("owner", "bundle", "term", F.col("of.nth").alias("nths"), F.col("of.w").alias("weights"))
    by_bundle = materialise(by_bundle, "owners")
    matched = materialise(_matched(lists, by_bundle, rows), "matched", "owner")
    met = _matched_bundles(matched.select("bundle", "block").distinct(), _rests(weighted, dealt), rows)
    state = blocks.select("block", "counts", "ids", "known").join(met, "block").mapInArrow(_shares(n_docs, n_terms), STATE)
    for stage in range(len(OWNERS)):
        own = matched.filter(F.col("owner") == stage).select("bundle", "block", "docs", "counts", "nths", "weights")
        last = stage == len(OWNERS) - 1
        done = state.groupBy("bundle", "block").cogroup(own.groupBy("bundle", "block")).applyInArrow(_stage(best, stage), FOUND if last else STATE)
        state = done if last else materialise(done, "accumulators")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = state.join(dealt, ["bundle", "nth"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return found.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = [np.frombuffer(b, "<i8") for b in batch.column("counts").to_pylist()]
        yield pa.record_batch(
            [pa.array([int((x > 0).sum()) for x in lengths], pa.int64()), pa.array([int(x.sum()) for x in lengths], pa.int64())], names=["n", "l"]
        )


def _rests(weighted: DataFrame, dealt: DataFrame) -> DataFrame:
    """For each bundle ``rests``: for every stage and item, what a document can still get after it."""
    later = [F.coalesce(F.sum(F.when(F.col("owner") > stage, F.col("w") * MOST)), F.lit(0).cast("long")) for stage in range(len(OWNERS))]
    per_item = weighted.groupBy("bundle", "nth").agg(F.array(*later).alias("later"))
    gathered = per_item.groupBy("bundle").agg(F.map_from_entries(F.collect_list(F.struct("nth", "later"))).alias("m"))
    places = F.sequence(F.lit(0).cast("long"), F.lit(BUNDLE - 1).cast("long"))

    def of_stage(stage: int):
        return F.transform(places, lambda nth: F.coalesce(F.try_element_at("m", nth)[stage], F.lit(0).cast("long")))

    return gathered.select("bundle", F.concat(*map(of_stage, range(len(OWNERS)))).alias("rests"))


def _matched_bundles(met: DataFrame, rests: DataFrame, rows: int) -> DataFrame:
    """The blocks that each bundle goes to, with its ``rests``."""
    if rows <= BROADCAST_ROWS:
        return met.join(F.broadcast(rests), "bundle")
    copies = rests.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    return met.withColumn("salt", F.pmod("block", F.lit(SALTS).cast("long"))).join(copies, ["bundle", "salt"]).drop("salt")
