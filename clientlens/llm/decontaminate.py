"""Benchmark passages in documents, exact or with a few edits, by the q-gram lemma.

Texts are compared in lower case with white space and control characters drawn together. An item of ``n`` code points that
occurs with at most ``k`` edits has at least ``n + 1 - q * (k + 1)`` of its q-grams in common with
the document, all of them on diagonals (place in the document less place in the item) that lie
within ``k`` of each other. So for each item the diagonals are dealt to bins of more than ``k``, two
neighbouring bins make a band, each band overlaps the next one by a bin, and only bands that hold
that many shared q-grams are kept. Their regions are verified by an alignment that looks at
the band's diagonals only.

The items are a stated query set. Items above ``PART_CHARS`` are cut into parts that overlap by two
long windows, and each part is looked for by itself. All are dealt to blocks by a hash, as many as
their measured size asks for at ``BLOCK_CHARS`` each, and a block that came out above ``MOST_CHARS`` is
dealt again; each block is broadcast and all documents are read against it. The shared q-grams of a
document are counted by stretches of it of about ``STRETCH`` postings, so a long text with very common
q-grams needs no more memory than a short one.

The edit budget is ``edits`` per code point; for short items it is lowered until the lemma asks for
one q-gram. Items longer than ``WINDOW`` are looked for in windows that overlap by half, and in
short windows of ``SHORT`` code points that overlap by half too. A verbatim quote of ``QUOTE`` code
points (191; 50 words of 2.8 letters) has a whole short window, so each is found, and longer ones
with as many edits as their windows allow. A short window has no row of its own where it lies in
an occurrence of a longer one of its item (or of its part). Defined results: items shorter than q and NULL texts match
nothing; documents without id and repeated ones are matched each for itself; items without id are
items like others, with a NULL ``item_id`` in the result; equal items are one; no items or no documents
give no rows; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, in_slices, ragged, strings
from .shingles import MIX, mixed

Q = 8
EDITS = 0.1
WINDOW = 512
SHORT = 128
#: The shortest quote of a long item that is found wherever it begins.
QUOTE = SHORT + SHORT // 2 - 1
BLOCK_CHARS = 4_000_000
PART_CHARS = 1_000_000
MOST_CHARS = 64_000_000
STRETCH = 1 << 20
MATCHES = "doc_id long, item_id long, begin long, end long, edits long"
BITS = 22
#: White space beyond Latin-1 (fixed values).
WIDE_BLANKS = "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with each stretch of white space as one blank, and the place of
    each of them in the text."""
    small = text.lower()
    if len(small) != len(text):
        small = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    points = np.frombuffer(small.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (points <= 32) | (points == 0x85) | (points == 0xA0)
    if len(points) and points.max() >= 0x1680:
        blank |= np.isin(points, [ord(c) for c in WIDE_BLANKS])
    points = np.where(blank, np.uint32(32), points)
    keep = ~(blank & np.concatenate([[True], blank[:-1]])) if len(points) else blank
    return points[keep], np.flatnonzero(keep)


def grams(points: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at each place; 2, 4 and 8 points at a time."""
    found, width = mixed(points.astype(np.uint64) + np.uint64(1)), 1
    while width < Q:
        if len(found) <= width:
            return np.empty(0, np.uint64)
        found = found[:-width] * MIX[width % 3] + found[width:]
        width *= 2
    return found ^ (found >> np.uint64(29))


@dataclass
class Block:
    """The q-gram index of some items, as arrays. A piece is a whole item or a window of one; long
    windows of an item come before short ones; ``sources`` has the number of the item's text."""

    pieces: list[np.ndarray]
    items: np.ndarray
    sources: np.ndarray
    budgets: np.ndarray
    least: np.ndarray
    shifts: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    piece: np.ndarray
    place: np.ndarray
    filter: np.ndarray


def windows(points: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Pieces of ``size`` that overlap by half or more; the last one ends where ``points`` do."""
    step = size // 2
    for at in range(0, len(points) - size + step, step):
        yield points[at : at + size] if at + size <= len(points) else points[-size:]


def index(items: list[tuple[int | None, str]], edits: float = EDITS) -> Block | None:
    """The index; None if no item is long enough."""
    pieces, ids, sources = [], [], []
    for source, (item, text) in enumerate(items):
        points = normalised(text)[0]
        if len(points) and points[-1] == 32:
            points = points[:-1]
        if len(points) < Q:
            continue
        cut = [points] if len(points) <= WINDOW else [*windows(points, WINDOW), *windows(points, SHORT)]
        pieces += cut
        ids += [item] * len(cut)
        sources += [source] * len(cut)
    if not pieces:
        return None
    sizes = np.array([len(p) for p in pieces])
    budgets = np.minimum((sizes * edits).astype(np.int64), sizes // Q - 1)
    per_piece = [grams(p) for p in pieces]
    counts = np.array([len(g) for g in per_piece])
    all_grams = np.concatenate(per_piece)
    order = np.argsort(all_grams, kind="stable")
    keys, first = np.unique(all_grams[order], return_index=True)
    filter_ = np.zeros(1 << BITS, bool)
    filter_[(keys >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return Block(
        pieces=pieces,
        items=np.array(ids, object),
        sources=np.array(sources, np.int64),
        budgets=budgets,
        least=sizes + 1 - Q * (budgets + 1),
        shifts=np.ceil(np.log2(budgets + 1)).astype(np.int64),
        keys=keys,
        first=np.append(first, len(order)),
        piece=np.repeat(np.arange(len(pieces)), counts)[order],
        place=ragged(np.zeros(len(pieces), np.int64), counts)[order],
        filter=filter_,
    )


def bands(points: np.ndarray, block: Block) -> list[tuple[int, int, int]]:
    """Piece, lowest and highest diagonal of the bands that hold enough shared q-grams; bands of a
    piece that overlap are one."""
    found = grams(points)
    at = np.flatnonzero(block.filter[(found >> np.uint64(64 - BITS)).astype(np.int64)])
    key = np.searchsorted(block.keys, found[at])
    key[key == len(block.keys)] = 0
    real = block.keys[key] == found[at]
    at, key = at[real], key[real]
    if not len(at):
        return []
    counts = block.first[key + 1] - block.first[key]
    stretch = (np.cumsum(counts) - counts) // STRETCH
    starts = np.flatnonzero(np.diff(stretch, prepend=-1))
    codes, hits = np.empty(0, np.int64), np.empty(0, np.int64)
    enough = []
    for low, high in zip(starts, [*starts[1:], len(at)]):
        post = ragged(block.first[key[low:high]], counts[low:high])
        piece, diagonal = block.piece[post], np.repeat(at[low:high], counts[low:high]) - block.place[post]
        # Diagonals can be below 0; they begin at -WINDOW.
        bins = (diagonal + WINDOW) >> block.shifts[piece]
        more, n = np.unique(piece * (1 << 40) + bins, return_counts=True)
        codes, same = np.unique(np.concatenate([codes, more]), return_inverse=True)
        hits = np.bincount(same, np.concatenate([hits, n])).astype(np.int64)
        piece, bins = codes >> 40, codes & ((1 << 40) - 1)
        next_to = np.concatenate([np.diff(codes) == 1, [False]])
        pair = hits + np.where(next_to, np.append(hits[1:], 0), 0)
        # No later q-gram can be on a diagonal of a band that ends a window before it.
        done = (bins + 2) << block.shifts[piece] <= at[high] if high < len(at) else np.ones(len(codes), bool)
        enough.append(codes[done & (pair >= block.least[piece])])
        codes, hits = codes[~done], hits[~done]
    enough = np.sort(np.concatenate(enough))
    piece, bins = enough >> 40, enough & ((1 << 40) - 1)
    merged: list[tuple[int, int, int]] = []
    for i in range(len(enough)):
        p, low = int(piece[i]), (int(bins[i]) << int(block.shifts[piece[i]])) - WINDOW
        high = low + (2 << int(block.shifts[p])) - 1
        if merged and merged[-1][0] == p and low <= merged[-1][2] + 1:
            merged[-1] = (p, merged[-1][1], high)
        else:
            merged.append((p, low, high))
    return merged


def align(points: np.ndarray, piece: np.ndarray, low: int, high: int, budget: int) -> list[tuple[int, int, int]]:
    """Begin, end and edits of the occurrences of ``piece`` whose alignment stays within ``budget``
    of the diagonals ``low`` to ``high``; occurrences that overlap count once, the best of them.

    Row ``i`` of the table has the fewest edits of the first ``i`` code points for each diagonal,
    with the place where that alignment begins.
    """
    low, high = low - budget, high + budget
    width, n = high - low + 1, len(piece)
    diagonals = np.arange(low, high + 1)
    steps = np.arange(width)
    far = np.int64(n + budget + 1)
    inside = (diagonals >= 0) & (diagonals <= len(points))
    # Costs and beginnings in one number: the begin counts from low and decides ties.
    scale = np.int64(len(points) + n + width + 2)
    cost = np.where(inside, diagonals - min(low, 0), far * scale)
    padded = np.full(width + n + 1, np.uint32(0xFFFFFFFF), np.uint32)
    a, b = max(low, 0), min(high + n, len(points))
    if b > a:
        padded[a - low : b - low] = points[a:b]
    for i in range(n):
        # Same diagonal: a point of each; the diagonal above: a point of the piece alone.
        straight = cost + np.where(padded[i : i + width] == piece[i], 0, scale)
        down = np.append(cost[1:], far * scale) + scale
        cost = np.minimum(straight, down)
        # Along a row: points of the document alone.
        cost = np.minimum.accumulate(cost - steps * scale) + steps * scale
        if cost.min() >= (budget + 1) * scale:
            return []
        place = diagonals + i + 1
        cost[(place < 0) | (place > len(points))] = far * scale
    edits = cost // scale
    begins, ends = cost % scale + min(low, 0), diagonals + n
    found: list[tuple[int, int, int]] = []
    for j in np.flatnonzero(edits <= budget).tolist():
        one = (int(begins[j]), int(ends[j]), int(edits[j]))
        if found and one[0] < found[-1][1]:
            if (one[2], one[1] - one[0]) < (found[-1][2], found[-1][1] - found[-1][0]):
                found[-1] = one
        else:
            found.append(one)
    return found


def occurrences(text: str, block: Block) -> Iterator[tuple[int | None, int, int, int]]:
    """Item, begin, end (places in the text) and edits of each occurrence."""
    points, places = normalised(text)
    if len(points) < Q:
        return
    long: dict[int, list[tuple[int, int]]] = {}
    for p, low, high in bands(points, block):
        piece, source = block.pieces[p], int(block.sources[p])
        # A band of merged bins is split so that the table of an alignment stays small.
        reach = max(4 * len(piece), 1024)
        seen: set[tuple[int, int, int]] = set()
        for a in range(low, high + 1, reach):
            b = min(a + reach - 1, high)
            begin = max(a - int(block.budgets[p]), 0)
            end = min(b + int(block.budgets[p]) + len(piece), len(points))
            window = points[begin:end]
            exact = window.tobytes().find(piece.tobytes()) if b - a < len(piece) else -1
            if exact >= 0 and exact % 4 == 0:
                # Any other occurrence in so narrow a band overlaps this one, which is the best.
                matches = [(exact // 4, exact // 4 + len(piece), 0)]
            else:
                matches = align(window, piece, a - begin, b - begin, int(block.budgets[p]))
            for found in matches:
                one = (found[0] + begin, found[1] + begin, found[2])
                if one not in seen and one[1] > one[0]:
                    seen.add(one)
                    # The pieces of an item come in the order in which they were cut.
                    if len(piece) == WINDOW:
                        long.setdefault(source, []).append(one[:2])
                    elif len(piece) == SHORT and any(a <= one[0] and one[1] <= b for a, b in long.get(source, ())):
                        continue
                    yield block.items[p], int(places[one[0]]), int(places[one[1] - 1]) + 1, one[2]


def _dealt(items: DataFrame, level: int = 0) -> Iterator[DataFrame]:
    """The items in blocks that can be broadcast. Parts are far smaller than a block, so dealing a
    block that is too large again ends."""
    # Windows of long items overlap by half, for two sizes: each code point is indexed four times.
    indexed_chars = F.length("text") * F.when(F.length("text") > WINDOW, 4).otherwise(1)
    chars = items.agg(F.coalesce(F.sum(indexed_chars), F.lit(0))).first()[0]
    blocks = -(-chars // BLOCK_CHARS)
    if level and chars <= MOST_CHARS:
        yield items
    elif blocks:
        of_block = F.pmod(F.xxhash64("item_id", "text", F.lit(level)), F.lit(blocks))
        for number in range(blocks):
            yield from _dealt(items.filter(of_block == number), level + 1)


def _items(benchmark: DataFrame) -> DataFrame:
    """The different items, those above ``PART_CHARS`` in overlapping parts."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("text IS NOT NULL").distinct()
    blanks = f"[\\x00-\\x20\\x85\\xA0{WIDE_BLANKS}]+"
    drawn = F.regexp_replace("text", blanks, " ")
    starts = F.sequence(F.lit(1), F.greatest(F.length("text") - 2 * WINDOW, F.lit(1)), F.lit(PART_CHARS - 2 * WINDOW))
    long = items.filter(F.length("text") > PART_CHARS).select("item_id", drawn.alias("text"))
    parts = long.select("item_id", "text", F.explode(starts).alias("start")).select("item_id", F.substr("text", F.col("start"), F.lit(PART_CHARS)).alias("text"))
    return items.filter(F.length("text") <= PART_CHARS).unionByName(parts.distinct())


def _hits(docs: DataFrame, benchmark: DataFrame, edits: float) -> DataFrame:
    """A row for each occurrence, with the hash of the document's text as ``key``."""
    spark = docs.sparkSession
    rows = documents(docs).withColumn("key", F.xxhash64("text"))
    found = spark.createDataFrame([], f"{MATCHES}, key long")
    for block in _dealt(_items(benchmark)):
        indexed = index([tuple(r) for r in block.toLocalIterator()], edits)
        if indexed is not None:
            found = found.unionByName(_against(rows, spark.sparkContext.broadcast(indexed)))
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """A row for each occurrence of an item: ``doc_id``, ``item_id``, ``begin``, ``end``, ``edits``."""
    return _hits(docs, benchmark, edits).drop("key")


def _against(docs: DataFrame, block) -> DataFrame:
    names = ["doc_id", "item_id", "begin", "end", "edits", "key"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), strings(batch)
            for low, high in in_slices(texts, 1 << 20):
                rows = [
                    (ids[i], *found, keys[i])
                    for i, text in enumerate(texts.slice(low, high - low).to_pylist(), low)
                    for found in occurrences(text, block.value)
                ]
                if rows:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return docs.mapInArrow(match, f"{MATCHES}, key long")


def clean_documents(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """The rows in whose text no item occurs, told apart by id (which may be NULL) and text."""
    hits = _hits(docs, benchmark, edits).select(F.col("doc_id").alias("id"), "key").distinct()
    rows = docs.select(F.struct("*").alias("row"))
    own_id, own_key = F.col("row.doc_id").cast("long"), F.xxhash64(F.col("row.text").cast("string"))
    return rows.join(hits, own_id.eqNullSafe(F.col("id")) & (own_key == F.col("key")), "left_anti").select("row.*")
