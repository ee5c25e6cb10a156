"""Language of documents by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text forwards and backwards with gated recurrent units of
``UNITS`` states and gives each position the probabilities of all languages; a document has the
mean over its positions. Gates are clipped lines (0 to 1) and candidates are clipped to -1 to 1, so
a step needs no exponential. A text is read in windows of ``WINDOW`` bytes that begin with states
of 0, thousands of them side by side; windows of all documents of a slice fill the same arrays.

Training is backpropagation through time in numpy, on about ``DOCS_A_LANGUAGE`` documents of each
language, dealt by a hash of the id. Their whole texts are cut into windows of ``TRAINED_BYTES`` bytes, which are
all used, up to about ``WINDOWS_A_LANGUAGE`` for each language; of more windows, that many are dealt by a
hash, evenly over all places of all texts.

Defined results: a text that is NULL or has no letter (Unicode's category L) is ``und`` with score 0; without any labelled
row all are ``und``; rows without id and repeated rows are labelled each for itself; no rows give no
rows; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, in_slices, ragged
from .shingles import MIX, mixed

UNITS = 8
WINDOW = 128
SIDE_BY_SIDE = 4096
DOCS_A_LANGUAGE = 400
WINDOWS_A_LANGUAGE = 1 << 15
TRAINED_BYTES = 64
STEPS = 240
BATCH = 192
#: Slope with which errors pass a clipped gate, so that it can open again.
LEAK = 0.05
WIDE_OPEN = 1e4
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


@dataclass
class Direction:
    """One reader: ``table`` has for each byte what it adds to both gates and the candidate."""

    table: np.ndarray
    gates: np.ndarray
    candidate: np.ndarray

    @classmethod
    def new(cls, rng: np.random.Generator) -> Direction:
        table = rng.normal(0, 0.3, (256, 3 * UNITS)).astype("f4")
        table[:, : 2 * UNITS] += 0.5
        # Byte 0 fills windows up: the gate is wide open and the state stays as it is.
        table[0] = 0
        table[0, :UNITS] = WIDE_OPEN
        scale = 0.5 / np.sqrt(UNITS)
        return cls(table, rng.normal(0, scale, (UNITS, 2 * UNITS)).astype("f4"), rng.normal(0, scale, (UNITS, UNITS)).astype("f4"))

    def read(self, steps: np.ndarray) -> np.ndarray:
        """States after each step; ``steps`` has a row of bytes for each step."""
        states = np.empty((len(steps), steps.shape[1], UNITS), "f4")
        state = np.zeros(states.shape[1:], "f4")
        for t, now in enumerate(steps):
            added = self.table.take(now, axis=0)
            gate = state @ self.gates
            gate += added[:, : 2 * UNITS]
            np.clip(gate, 0, 1, out=gate)
            keep, reset = gate[:, :UNITS], gate[:, UNITS:]
            reset *= state
            new = reset @ self.candidate
            new += added[:, 2 * UNITS :]
            np.clip(new, -1, 1, out=new)
            state = state - new
            state *= keep
            state += new
            states[t] = state
        return states

    def learn(self, steps: np.ndarray, states: np.ndarray, errors: np.ndarray) -> list[np.ndarray]:
        """Gradients of table, gates and candidate for the errors of the states."""
        d_gates, d_candidate = np.zeros_like(self.gates), np.zeros_like(self.candidate)
        d_added = np.empty((*steps.shape, 3 * UNITS), "f4")
        back = np.zeros_like(states[0])
        for t in range(len(steps) - 1, -1, -1):
            before = states[t - 1] if t else np.zeros_like(states[0])
            added = self.table[steps[t]]
            raw = before @ self.gates + added[:, : 2 * UNITS]
            gate = np.clip(raw, 0, 1)
            keep, reset = gate[:, :UNITS], gate[:, UNITS:]
            raw_new = (reset * before) @ self.candidate + added[:, 2 * UNITS :]
            new = np.clip(raw_new, -1, 1)
            error = errors[t] + back
            d_new = error * (1 - keep) * np.where(np.abs(raw_new) < 1, 1, LEAK)
            d_reset_state = d_new @ self.candidate.T
            d_gate = np.concatenate([error * (before - new), d_reset_state * before], 1)
            d_gate *= np.where((raw > 0) & (raw < 1), 1, LEAK)
            back = error * keep + d_reset_state * reset + d_gate @ self.gates.T
            d_candidate += (reset * before).T @ d_new
            d_gates += before.T @ d_gate
            d_added[t, :, : 2 * UNITS], d_added[t, :, 2 * UNITS :] = d_gate, d_new
        d_table = np.zeros_like(self.table)
        np.add.at(d_table, steps.ravel(), d_added.reshape(-1, 3 * UNITS))
        d_table[0] = 0
        return [d_table, d_gates, d_candidate]


@dataclass
class Network:
    names: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray
    bias: np.ndarray

    def states(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        steps = np.ascontiguousarray(windows.T)
        return self.forward.read(steps), self.backward.read(steps[::-1])[::-1]

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Of each step and window, for each language."""
        ahead, behind = self.states(windows)
        found = ahead @ self.out[:UNITS]
        found += behind @ self.out[UNITS:]
        found += self.bias
        found -= found.max(2, keepdims=True)
        np.exp(found, out=found)
        found /= found.sum(2, keepdims=True)
        return found


def train(names: list[str], windows: np.ndarray, labels: np.ndarray, seed: int = 1) -> Network:
    """A network from windows of bytes (rows, padded with 0) and the number of each one's language."""
    rng = np.random.default_rng(seed)
    net = Network(names, Direction.new(rng), Direction.new(rng), rng.normal(0, 0.3, (2 * UNITS, len(names))).astype("f4"), np.zeros(len(names), "f4"))
    weights = [net.forward.table, net.forward.gates, net.forward.candidate, net.backward.table, net.backward.gates, net.backward.candidate, net.out, net.bias]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    by_language = [np.flatnonzero(labels == i) for i in range(len(names))]
    for step in range(1, STEPS + 1):
        # As many windows of each language in a batch.
        language = rng.integers(0, len(names), BATCH)
        picked = np.array([rng.choice(by_language[i]) for i in language])
        own = windows[picked].copy()
        # One in eight ends early, as texts do.
        for row in np.flatnonzero(rng.random(BATCH) < 0.125):
            own[row, rng.integers(8, own.shape[1]) :] = 0
        steps = np.ascontiguousarray(own.T)
        ahead, behind = net.states(own)
        found = ahead @ net.out[:UNITS] + behind @ net.out[UNITS:] + net.bias
        found = np.exp(found - found.max(2, keepdims=True))
        found /= found.sum(2, keepdims=True)
        error = found.copy()
        error[:, np.arange(BATCH), language] -= 1
        error *= (steps > 0)[:, :, None] / np.float32(steps.size)
        flat = error.reshape(-1, len(names))
        d_out = np.concatenate([ahead.reshape(-1, UNITS).T @ flat, behind.reshape(-1, UNITS).T @ flat])
        slopes = net.forward.learn(steps, ahead, error @ net.out[:UNITS].T)
        slopes += net.backward.learn(steps[::-1], behind[::-1], (error @ net.out[UNITS:].T)[::-1])
        slopes += [d_out, flat.sum(0)]
        rate = 0.02 * min(1, step / 20) * (1 - step / (STEPS + 1))
        for w, d, m, s in zip(weights, slopes, mean, square):
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


def learn(docs: DataFrame, docs_a_language: int = DOCS_A_LANGUAGE) -> Network | None:
    """Learn from ``text`` and ``lang`` of the rows that have both."""
    known = docs.filter("lang IS NOT NULL AND length(text) > 0").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    of_language = F.create_map(*(F.lit(x) for pair in counts.items() for x in pair))[F.col("lang")]
    known = known.filter(F.pmod(F.xxhash64("doc_id"), of_language) < docs_a_language)
    known = known.select("lang", F.xxhash64("doc_id", "text").alias("nth"), "text")
    sizes = known.groupBy("lang").agg(F.sum(F.ceil(F.octet_length("text") / TRAINED_BYTES)).alias("n")).collect()
    shares = {r.lang: WINDOWS_A_LANGUAGE / r.n for r in sizes}
    rows = known.mapInArrow(_windows(shares), "lang string, nth long, place long, part binary").orderBy("lang", "nth", "place").collect()
    names = sorted({r.lang for r in rows})
    if not names:
        return None
    windows = np.zeros((len(rows), TRAINED_BYTES), np.uint8)
    for row, r in zip(windows, rows):
        row[: len(r.part)] = np.frombuffer(r.part, np.uint8)
    return train(names, windows, np.array([names.index(r.lang) for r in rows]))


def _windows(shares: dict[str, float]):
    """All windows of the texts that have a letter, or a share of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, nth, text in zip(*(batch.column(c) for c in ("lang", "nth", "text"))):
                name, content = lang.as_py(), text.as_py().encode()
                places = np.arange(-(-len(content) // TRAINED_BYTES))
                if shares[name] < 1:
                    drawn = mixed(places.astype(np.uint64) * MIX[0] ^ np.uint64(nth.as_py() % (1 << 64)))
                    places = places[drawn < np.uint64(shares[name] * 2**64)]
                parts = [(p, content[p * TRAINED_BYTES : (p + 1) * TRAINED_BYTES]) for p in places.tolist()]
                parts = [(p, part) for p, part in parts if LETTER.search(part.decode(errors="ignore"))]
                yield pa.record_batch(
                    [
                        pa.array([name] * len(parts), pa.string()),
                        pa.array([nth.as_py()] * len(parts), pa.int64()),
                        pa.array([p for p, _ in parts], pa.int64()),
                        pa.array([part for _, part in parts], pa.binary()),
                    ],
                    names=["lang", "nth", "place", "part"],
                )

    return run


def label(texts: pa.Array, net: Network) -> np.ndarray:
    """Mean probabilities of each language over all positions of each text; texts without a byte
    have zeros."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    content = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    starts = offsets[:-1][owner] + ragged(np.zeros(len(texts), np.int64), counts) * WINDOW
    lengths = np.minimum(offsets[1:][owner] - starts, WINDOW)
    sums = np.zeros((len(texts), len(net.names)))
    # Windows of like length side by side: full ones first, then the ends of texts by length.
    order = np.argsort(-lengths, kind="stable")
    for at in range(0, len(order), SIDE_BY_SIDE):
        rows = order[at : at + SIDE_BY_SIDE]
        width = int(lengths[rows[0]])
        real = np.arange(width) < lengths[rows][:, None]
        windows = content[np.minimum(starts[rows][:, None] + np.arange(width), max(len(content) - 1, 0))]
        windows = np.where(real, windows, np.uint8(0))
        found = net.probabilities(windows)
        if lengths[rows[-1]] < width:
            found *= real.T[:, :, None]
        np.add.at(sums, owner[rows], found.sum(0))
    return sums / np.maximum(sizes, 1)[:, None]


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score``, the mean probability of that language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            texts = pa.array(texts.to_pylist(), pa.large_string()) if texts.offset else texts
            texts = texts.fill_null("")
            for low, high in in_slices(texts, 2 << 20):
                part = texts.slice(low, high - low)
                written = np.array([bool(LETTER.search(t)) for t in part.to_pylist()])
                if net is None:
                    names, score = [UNKNOWN] * len(part), np.zeros(len(part))
                else:
                    found = label(part, net)
                    best = found.argmax(1)
                    score = np.where(written, found[np.arange(len(part)), best], 0.0).clip(0, 1)
                    names = [net.names[b] if w else UNKNOWN for b, w in zip(best, written)]
                yield pa.record_batch([batch.column("doc_id").slice(low, high - low), pa.array(names, pa.string()), score], names=["doc_id", "lang_pred", "score"])

    return documents(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
