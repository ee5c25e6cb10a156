"""Toxicity by a weighted lexicon that an Aho-Corasick automaton finds in folded text.

*Folding* makes small letters, maps look-alikes of other scripts and digits or signs that stand for
letters to one letter each (i, l, 1, ! and | are one), drops invisible characters and turns marks
and white space into blanks, so ``1d!0t`` is ``idiot``.

*Lexicon.* Whole words, and beginnings of words of ``PREFIX`` letters, get as weight the log of the
ratio of the shares of toxic and other labelled documents that have them. All labelled rows count;
every term stays whose number of toxic documents is ``LEAST_Z`` standard deviations above chance and
whose weight is ``LEAST_WEIGHT`` at least. ``SEED`` words have a weight where the labels say nothing.
A lexicon of more than ``LEXICON_TERMS`` terms is a table, dealt to blocks of about that many by the
first ``PREFIX`` letters, so all terms of a word are in one block and the sums of blocks add up. All
texts are read against each block; their sums meet by two hashes of the text.

*Score.* A word counts with its heaviest term unless it stands in one of the exception phrases. The
sum of weights, divided by the number of words, goes through a logistic function, which is fitted on about ``FIT_ROWS`` labelled rows, dealt by a hash of the id, or all if there are fewer.

Defined results: NULL and empty texts have no words and the score of a text without a hit; labels
other than 0 and 1 aren't used, of several labels of an id the largest is; without any label
the seed lexicon and ``UNFITTED`` are used; repeated rows and rows without id are scored each for
itself; no rows give no rows; further columns are left out.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, in_slices, materialise, strings

PREFIX = 6
LEAST_Z = 5.0
LEAST_WEIGHT = 3.0
#: Terms that go to the executors at once; no more than a block of them is on the driver.
LEXICON_TERMS = 20_000
FIT_ROWS = 20_000
#: Labels up to this many rows (16 bytes each) are broadcast; more are joined by a shuffle.
LABELS_BROADCAST = 1_000_000
TERMS_A_FLUSH = 150_000
UNFITTED = np.array([-3.0, 1.5])

# The lexicon where labels say nothing, phrases that are harmless, and look-alikes.
SEED = dict.fromkeys(("idiot", "moron", "scum", "stupid", "pathetic", "worthless", "disgusting", "loser"), 2.0)
EXCEPTIONS = ("trash can", "trash bin", "trash collection", "class clown", "circus clown", "clown fish", "stupid mistake", "pond scum", "soap scum")
LOOK_ALIKES = {
    "a": "4@аα", "b": "8в", "c": "сϲ", "d": "ԁ", "e": "3еε", "g": "9ɡ", "h": "һн", "i": "1!|lіιӏ", "j": "ј", "k": "кκ",
    "m": "м", "n": "ո", "o": "0оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "5$ѕ", "t": "7+тτ", "u": "υս", "v": "ѵν", "w": "ѡԝ",
    "x": "хχ", "y": "уγ", "z": "2ᴢ",
}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
MARKS = "".join(c for c in string.punctuation if not any(c in x for x in LOOK_ALIKES.values()))
OTHER_MARKS = "¡«·»¿" + "".join(map(chr, range(0x2010, 0x2028))) + "‰‹›"
FOLD = {ord(c): a for a, likes in LOOK_ALIKES.items() for c in likes}
FOLD |= {ord(c): " " for c in MARKS + OTHER_MARKS + "\t\n\x0b\x0c\r\u0085\u00a0\u2028\u2029"} | {ord(c): None for c in INVISIBLE}
#: Signs that don't stand for a letter: several of them, or one at the end of a word.
SIGNS = re.compile(r"[!|+$@]{2,}|[!|+$@](?!\w)")


def fold(text: str) -> str:
    """The text as words with one blank or more between them, and at both ends."""
    return SIGNS.sub(" ", f" {text} ".lower()).translate(FOLD)


def terms_of(word: str) -> tuple[str, ...]:
    """A word as it stands between blanks, and its beginning if it is longer."""
    return (f" {word} ", f" {word[:PREFIX]}") if len(word) > PREFIX else (f" {word} ",)


def _counts(rows: DataFrame) -> DataFrame:
    """For each term the toxic and the other documents that have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}

        def flush() -> pa.RecordBatch:
            numbers = np.array(list(seen.values()), np.int64).reshape(-1, 2)
            batch = pa.record_batch([pa.array(list(seen), pa.string()), numbers[:, 0].copy(), numbers[:, 1].copy()], names=["term", "clean", "toxic"])
            seen.clear()
            return batch

        for batch in batches:
            labels = batch.column("toxic").to_pylist()
            texts = strings(batch)
            for low, high in in_slices(texts, 1 << 20):
                for label, text in zip(labels[low:high], texts.slice(low, high - low).to_pylist()):
                    words = set(fold(text).split())
                    for term in {f" {w} " for w in words} | {f" {w[:PREFIX]}" for w in words if len(w) > PREFIX}:
                        have = seen.get(term)
                        if have is None:
                            have = seen[term] = [0, 0]
                        have[label] += 1
                if len(seen) > TERMS_A_FLUSH:
                    yield flush()
        if seen:
            yield flush()

    found = rows.select("toxic", "text").mapInArrow(count, "term string, clean long, toxic long")
    return found.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def learn_lexicon(rows: DataFrame) -> Lexicon | WideLexicon:
    """Terms and weights from labelled rows (``text``, ``toxic`` 0 or 1)."""
    weights = {term: w for word, w in SEED.items() for term in terms_of(fold(word).strip())[:1]}
    clean, toxic = rows.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first()
    if not toxic or not clean:
        return Lexicon(weights)
    share = toxic / (toxic + clean)
    n = F.col("toxic") + F.col("clean")
    z = (F.col("toxic") - n * share) / F.sqrt(n * share * (1 - share))
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    best = _counts(rows).select("term", weight.alias("weight"), z.alias("z")).filter((F.col("z") >= LEAST_Z) & (F.col("weight") >= LEAST_WEIGHT))
    best = materialise(best.select("term", "weight"), "lexicon")
    n_terms = best.count()
    if n_terms > LEXICON_TERMS:
        return WideLexicon(best, weights, -(-n_terms // LEXICON_TERMS))
    return Lexicon(weights | {row.term: row.weight for row in best.collect()})


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            term = f" {' '.join(fold(phrase).split())} "
            found.add_word(term, (len(term), None))
        found.make_automaton()
        return found


@dataclass
class WideLexicon:
    """A lexicon in ``blocks`` parts: a table of ``term`` and ``weight``, and words for what it lacks."""

    terms: DataFrame
    seed: dict[str, float]
    blocks: int

    def block(self, number: int) -> Lexicon:
        own = self.terms.filter(F.crc32(F.substring("term", 2, PREFIX)) % self.blocks == number)
        seed = {t: w for t, w in self.seed.items() if zlib.crc32(t[1 : 1 + PREFIX].encode()) % self.blocks == number}
        return Lexicon(seed | {row.term: row.weight for row in own.collect()})


def density(text: str, automaton) -> float:
    """The sum of weights for each 100 words."""
    folded = fold(text)
    n_words = len(folded.split())
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(folded):
        begin = end - length + 1
        if weight is None:
            spared.append((begin, end))
        elif weight > best.get(begin, 0.0):
            best[begin] = weight
    total = sum(w for at, w in best.items() if not any(a <= at < b for a, b in spared))
    return 100 * total / max(n_words, 1)


def densities(texts: pa.Array, automaton) -> np.ndarray:
    return np.array([density(t, automaton) for t in texts.to_pylist()], float)


def _scored(rows: DataFrame, lexicon: Lexicon, extra: str, columns: list[str]) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            texts = strings(batch)
            for low, high in in_slices(texts, 1 << 20):
                own = [batch.column(c).slice(low, high - low) for c in columns]
                found = densities(texts.slice(low, high - low), automaton)
                yield pa.record_batch([*own, found], names=[*columns, "density"])

    return rows.select(*columns, "text").mapInArrow(score, f"{extra}, density double")


def _text_hashes() -> list[Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")]


def _beside_densities(rows: DataFrame, lexicon: WideLexicon) -> DataFrame:
    """``row``, a struct of all columns, and ``density`` over all blocks of the lexicon."""
    keyed = rows.select(*_text_hashes(), F.col("text").cast("string").alias("text"))
    found = None
    for number in range(lexicon.blocks):
        scored = _scored(keyed, lexicon.block(number), "h1 long, h2 long", ["h1", "h2"]).filter("density > 0")
        part = materialise(scored.groupBy("h1", "h2").agg(F.max("density").alias("part")).withColumn("number", F.lit(number)), "densities")
        found = part if found is None else found.unionByName(part)
    # In the order of the blocks, so that a run gives the same sum as another.
    parts = F.sort_array(F.collect_list(F.struct("number", "part")))
    total = F.aggregate(parts, F.lit(0.0), lambda done, p: done + p.part)
    sums = found.groupBy("h1", "h2").agg(total.alias("total"))
    marked = rows.select(F.struct("*").alias("row"), *_text_hashes())
    return marked.join(sums, ["h1", "h2"], "left").select("row", F.coalesce("total", F.lit(0.0)).alias("density"))


def with_density(rows: DataFrame, lexicon: Lexicon | WideLexicon, extra: str, columns: list[str]) -> DataFrame:
    """The ``columns`` of each row and its ``density``."""
    if isinstance(lexicon, Lexicon):
        return _scored(rows, lexicon, extra, columns)
    return _beside_densities(rows, lexicon).select(*(F.col("row")[c].alias(c) for c in columns), "density")


def fit(density: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Coefficients of the logistic function by Newton's steps, slightly drawn to 0."""
    if len(np.unique(label)) < 2:
        return UNFITTED
    x = np.column_stack([np.ones(len(label)), np.log1p(density)])
    at = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ at))
        slope = x.T @ (label - p) - 1e-2 * at
        at = at + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), slope)
    return at


@dataclass
class Model:
    lexicon: Lexicon | WideLexicon
    coefficients: np.ndarray


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from the documents that have a label; ``labels`` has ``doc_id`` and ``toxic``."""
    marked = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    if labels.limit(LABELS_BROADCAST + 1).count() <= LABELS_BROADCAST:
        marked = F.broadcast(marked)
    rows = documents(docs).join(marked, "doc_id")
    lexicon = learn_lexicon(rows)
    n = rows.count()
    few = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(max(n, 1))) < fit_rows)
    known = np.array(with_density(few, lexicon, "toxic long", ["toxic"]).collect()).reshape(-1, 2)
    return Model(lexicon, fit(known[:, 1], known[:, 0]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of each row."""
    a, b = (float(x) for x in model.coefficients)
    found = with_density(documents(docs), model.lexicon, "doc_id long", ["doc_id"])
    return found.select("doc_id", (1 / (1 + F.exp(-(a + b * F.log1p("density"))))).alias("score"))


def clean_documents(docs: DataFrame, model: Model, below: float = 0.5) -> DataFrame:
    """The documents whose score is below the limit, with all their columns."""
    import pyspark.sql.types as T

    schema = T.StructType([*docs.schema.fields])
    a, b = (float(x) for x in model.coefficients)
    lexicon = model.lexicon
    if isinstance(lexicon, WideLexicon):
        value = 1 / (1 + F.exp(-(a + b * F.log1p("density"))))
        kept = _beside_densities(docs, lexicon).filter(value < below)
        return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            texts = strings(batch)
            for low, high in in_slices(texts, 1 << 20):
                found = densities(texts.slice(low, high - low), automaton)
                value = 1 / (1 + np.exp(-(a + b * np.log1p(found))))
                yield batch.slice(low, high - low).filter(pa.array(value < below))

    return docs.mapInArrow(choose, schema)
