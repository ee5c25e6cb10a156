"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Class ``k`` takes pieces that are longer than ``capacity / (k + 1)`` and at most ``capacity / k``
tokens, and each of its sequences takes exactly ``k`` of them. So a worker packs the rows it reads
with a counter for each class, without a look at other workers or at other classes. Pieces of
class ``classes`` and above are short; these are filled up one after the other.

Documents longer than the capacity are cut into full sequences. What is left is cut once more when
its class would leave more than ``1 / SLACK`` of its share empty: off comes a piece that fills a
share of the next class, and the rest is looked at again. The few sequences that are not full at
the end of a worker are taken apart; their pieces, fewer than the sum of all classes a worker, are
packed best fit, longest first, in groups of ``WORKERS_A_GROUP`` workers.

Defined results: NULL text is the empty text (the end id alone); rows with equal or NULL id are
packed each for itself; an empty table gives no pieces; further columns are left out. Every id
lies in exactly one piece, pieces of a sequence follow each other without a gap.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, in_slices, materialise, strings
from .tokenize import encoder, with_end

CAPACITY = 4096
CLASSES = 64
SLACK = 128
WORKERS_A_GROUP = 64
COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
PIECES = pa.schema(
    [(c, pa.int64()) for c in COLUMNS] + [("ids", pa.binary())] + [(c, pa.int64()) for c in ("sequence_id", "offset", "worker")]
)
PIECES_SQL = ", ".join(f"{c} long" for c in COLUMNS) + ", ids binary, sequence_id long, offset long, worker long"
#: Sequence ids: the worker in the upper bits, the number among its sequences in the lower ones.
SHIFT = 40


def cut(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut documents of these lengths; gives each piece's document, start and length."""
    full = lengths // capacity
    doc = np.repeat(np.arange(len(lengths)), full)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)
    found = [(doc, within * capacity, np.full(len(doc), capacity))]
    doc, start = np.arange(len(lengths)), full * capacity
    rest = lengths - start
    while len(doc := doc[rest > 0]):
        start, rest = start[rest > 0], rest[rest > 0]
        k = capacity // rest
        share = capacity // k
        whole = (k >= CLASSES) | ((share - rest) * SLACK <= share)
        length = np.where(whole, rest, capacity // (k + 1))
        found.append((doc, start, length))
        start, rest = start + length, rest - length
    doc, start, length = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((start, doc))
    return doc[order], start[order], length[order]


class Harmonic:
    """The open sequences of one worker. ``add`` gives the pieces whose sequence became full."""

    def __init__(self, worker: int, capacity: int) -> None:
        self.worker, self.capacity, self.next = worker, capacity, worker << SHIFT
        self.open: dict[int, pa.Table] = {}

    def add(self, pieces: pa.Table) -> Iterator[pa.Table]:
        classes = np.minimum(self.capacity // pieces["length"].to_numpy(), CLASSES)
        for k in np.unique(classes).tolist():
            mine = pieces.take(np.flatnonzero(classes == k))
            if k in self.open:
                mine = pa.concat_tables([self.open.pop(k), mine])
            lengths = mine["length"].to_numpy()
            if k < CLASSES:
                number = np.arange(len(lengths)) // k
                done = len(lengths) - len(lengths) % k
            else:
                number = self._fill_up(lengths)
                done = int(np.searchsorted(number, number[-1]))
            if done < len(lengths):
                self.open[k] = mine.slice(done)
            if done:
                yield self._placed(mine.slice(0, done), number[:done], lengths[:done])

    def _fill_up(self, lengths: np.ndarray) -> np.ndarray:
        """Pieces in their order, as many in a sequence as fit."""
        ends = np.concatenate([[0], np.cumsum(lengths)])
        cuts, at = [], 0
        while at < len(lengths):
            cuts.append(at)
            at = int(np.searchsorted(ends, ends[at] + self.capacity, "right")) - 1
        return np.searchsorted(cuts, np.arange(len(lengths)), "right") - 1

    def _placed(self, pieces: pa.Table, number: np.ndarray, lengths: np.ndarray) -> pa.Table:
        ends = np.cumsum(lengths)
        first = np.searchsorted(number, number)
        offset = (ends - lengths) - (ends - lengths)[first]
        sequence = self.next + number
        self.next += int(number[-1]) + 1
        return _finished(pieces, sequence, offset, self.worker)

    def rest(self) -> Iterator[pa.Table]:
        """Pieces of sequences that are not full."""
        for pieces in self.open.values():
            nothing = pa.nulls(len(pieces), pa.int64())
            yield _finished(pieces, nothing, nothing, self.worker)


def _finished(pieces: pa.Table, sequence, offset, worker: int) -> pa.Table:
    columns = [pieces[c] for c in (*COLUMNS, "ids")]
    return pa.Table.from_arrays([*columns, pa.array(sequence), pa.array(offset), pa.array(np.full(len(pieces), worker))], schema=PIECES)


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece: longest first, each where it leaves the least room."""
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []
    sequence, offset, n = [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect.bisect_left(rooms, lengths[i])
        if at < len(rooms):
            room = rooms[at]
            number = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        else:
            room, number, n = capacity, n, n + 1
        sequence[i], offset[i] = number, capacity - room
        if left := room - lengths[i]:
            if left not in by_room:
                by_room[left] = []
                bisect.insort(rooms, left)
            by_room[left].append(number)
    return sequence, offset


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = True
) -> DataFrame:
    """Pieces of all documents with their sequence and offset, and with the ids of each piece as
    little-endian 32-bit integers if ``with_ids``."""
    rows = documents(docs)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, open_ones = encoder(tokenizer), Harmonic(TaskContext.get().partitionId(), capacity)
        for batch in batches:
            texts = strings(batch)
            for low, high in in_slices(texts):
                ids, bounds = with_end(*encode.columns(texts.slice(low, high - low)), end_id)
                ids = ids.astype("<u4")
                doc, start, length = cut(np.diff(bounds), capacity)
                at = bounds[doc] + start
                spans = list(zip(at.tolist(), (at + length).tolist()))
                pieces = pa.table(
                    {
                        "doc_id": batch.column("doc_id").slice(low, high - low).take(pa.array(doc)),
                        "start": start,
                        "length": length,
                        "ids_crc32": np.array([zlib.crc32(ids[a:b]) for a, b in spans], np.int64),
                        "doc_tokens": np.diff(bounds)[doc],
                        "ids": pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary())
                        if with_ids
                        else pa.nulls(len(doc), pa.binary()),
                    }
                )
                for full in open_ones.add(pieces):
                    yield from full.to_batches()
        encode.forget()
        for left in open_ones.rest():
            yield from left.to_batches()

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        for batch in batches:
            part = pa.Table.from_batches([batch]).cast(PIECES)
            groups = part["worker"].to_numpy() // WORKERS_A_GROUP
            for group in np.unique(groups).tolist():
                if waiting and waiting[0]["worker"][0].as_py() // WORKERS_A_GROUP != group:
                    yield from fitted(pa.concat_tables(waiting)).to_batches()
                    waiting = []
                waiting.append(part.filter(pa.array(groups == group)))
        if waiting:
            yield from fitted(pa.concat_tables(waiting)).to_batches()

    def fitted(pieces: pa.Table) -> pa.Table:
        sequence, offset = best_fit(pieces["length"].to_pylist(), capacity)
        group = pieces["worker"][0].as_py() // WORKERS_A_GROUP
        # The highest bit below the sign keeps these apart from the workers' own sequences.
        sequence = np.array(sequence, np.int64) + (1 << 62) + (group << SHIFT)
        order = np.lexsort((offset, sequence))
        return _finished(pieces.take(order), sequence[order], np.array(offset, np.int64)[order], group)

    packed = materialise(rows.mapInArrow(fill, PIECES_SQL), "packed")
    left = packed.filter(F.col("sequence_id").isNull())
    group = F.floor(F.col("worker") / WORKERS_A_GROUP)
    order = [F.col(c) for c in ("worker", "length", "doc_id", "start")]
    again = left.repartition(group).sortWithinPartitions(*order).mapInArrow(fit, PIECES_SQL)
    return packed.filter(F.col("sequence_id").isNotNull()).unionByName(again).drop("worker")
