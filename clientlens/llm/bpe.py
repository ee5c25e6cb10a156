"""Byte-pair encoding and decoding with the vocabulary and merges of a public tokenizer file.

The merges of a piece are applied from a priority queue. Its symbols are a doubly linked list
(places of the neighbours before and after, kept in two arrays), the queue holds ``(rank, place)``
of every pair that has a merge, and the pair with the least rank, the leftmost among equals, is
popped first. An entry is stale when the pair at its place has another rank by now, or none; it is
skipped. So a piece of n symbols takes n log n steps however long it is. Decoding
concatenates the strings of the vocabulary, with a space between tokens, as the library does for a
file without a decoder.

What comes before the merges is the file's: its normaliser and its division into pieces are asked
for from the library, word by word, and tokens that the file adds are cut out of a text first. The
division must not look across white space; :class:`Merges` refuses a file that does.

Words repeat, so those of a slice of rows are dictionary-encoded by Arrow and each distinct word is
merged once; a task keeps the ids of words within ``CHARS_KEPT`` code points, and forgets all of them
when that is full, which costs time only.

Defined results: NULL text is the empty text, which has no ids and decodes to the empty text; texts of
white space too; NULL ids of documents stay, equal rows are encoded each for itself, an empty table
gives no rows; further columns are left out. A NULL list of ids decodes to the empty text. An id that is
NULL or beyond the vocabulary can't be decoded and is an error.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache, partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import documents, in_slices, ragged, strings

#: Code points of words whose ids a task keeps.
CHARS_KEPT = 4 << 20
#: Text encoded at once, and ids decoded at once; ids take more room than the text they stand for.
SLICE_BYTES, SLICE_IDS = 2 << 20, 1 << 19
#: Words that are divided into pieces together.
WORDS_A_CALL = 1024
#: Bits of a place in an entry of the queue.
PLACE, HERE = 40, (1 << 40) - 1
#: Symbols from which on the lists of a piece are arrays, which take less room.
LONG = 1 << 14
#: Words of Latin letters, digits and marks, none of them white space in any edition of Unicode.
PLAIN = re.compile("[\x21-\x7e\xa1-\u024f]+")
PROBES = ("a b", " a  b ", "a\nb", "a\t\r\x0b\x0cb")


def listed(spec: dict) -> list[str]:
    """The strings of a tokenizer file by their ids."""
    named = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
    names = [""] * (1 + max(named.values()))
    for name, at in named.items():
        names[at] = name
    return names


class Merges:
    """The tables of a tokenizer file: symbols, ranked merges and added tokens."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as handle:
            spec = json.load(handle)
        model = spec["model"]
        unused = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or any(model.get(k) for k in unused) or spec.get("decoder"):
            raise ValueError("this tokenizer file asks for more than merges")
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = self.vocabulary
        #: Pairs of ids with the rank of their merge, and the id that the merge of a rank gives.
        self.ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.given = [ids[a + b] for a, b in pairs]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        if any(t[k] for t in spec.get("added_tokens") or () for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("this tokenizer file has added tokens that look around themselves")
        self.added = added
        longest_first = sorted(added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        self.names = listed(spec)
        library = Tokenizer.from_file(path)
        self.normaliser, self.divider = library.normalizer, library.pre_tokenizer
        wanted = self.encode("a") + self.encode("b")
        if any(self.encode(text) != wanted for text in PROBES):
            raise ValueError("this tokenizer file gives white space ids of its own")

    def merge(self, symbols: list[int]) -> list[int]:
        """The ids that are left of a piece's symbols when no pair of neighbours has a merge."""
        n, rank_of, given = len(symbols), self.ranks.get, self.given
        made = list if n < LONG else partial(array, "q")
        before, after = made(range(-1, n - 1)), made(range(1, n + 1))
        # The rank of the pair that begins at each place by now; entries of other ranks are stale.
        now = made(map(rank_of, zip(symbols, symbols[1:]), repeat(-1)))
        if n:
            after[-1] = -1
            now.append(-1)
        # An entry is one number, the rank above the place: it takes half the room of a pair.
        queue = [rank << PLACE | at for at, rank in enumerate(now) if rank >= 0]
        heapq.heapify(queue)
        while queue:
            first = heapq.heappop(queue)
            rank, at = first >> PLACE, first & HERE
            if now[at] != rank:
                continue
            right = after[at]
            symbols[at], symbols[right], now[right] = given[rank], -1, -1
            beyond, left = after[right], before[at]
            after[at] = beyond
            now[at] = -1
            if beyond >= 0:
                before[beyond] = at
                now[at] = rank = rank_of((symbols[at], symbols[beyond]), -1)
                if rank >= 0:
                    heapq.heappush(queue, rank << PLACE | at)
            if left >= 0:
                now[left] = rank = rank_of((symbols[left], symbols[at]), -1)
                if rank >= 0:
                    heapq.heappush(queue, rank << PLACE | left)
        return [s for s in symbols if s >= 0]

    def pieces(self, text: str) -> list[str]:
        """Text without added tokens as the pieces that merges don't cross."""
        if self.normaliser is not None:
            text = self.normaliser.normalize_str(text)
        return [piece for piece, _ in self.divider.pre_tokenize_str(text)] if self.divider is not None else [text]

    def ids_of(self, piece: str) -> list[int]:
        marks = [*piece[:-1], piece[-1] + self.suffix]
        # A mark that isn't in the vocabulary has no id, and there is no unknown one.
        return self.merge([self.vocabulary[m] for m in marks if m in self.vocabulary])

    def encode(self, text: str) -> list[int]:
        """The ids of any text."""
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else (text,):
            if part in self.added:
                out.append(self.added[part])
                continue
            for piece in self.pieces(part) if part else ():
                out += self.ids_of(piece)
        return out

    def encode_words(self, words: list[str], met: dict[str, tuple[int, ...]]) -> list[tuple[int, ...]]:
        """The ids of many words without white space; ``met`` has the ids of pieces met before.

        Plain words are divided into pieces together, with spaces between them; the place of a
        piece tells its word. Words with an added token, and others, are encoded each for itself.
        """
        out: list[tuple[int, ...]] = [()] * len(words)
        plain = []
        for i, word in enumerate(words):
            if PLAIN.fullmatch(word) and not (self.cut and self.cut.search(word)):
                plain.append(i)
            else:
                out[i] = tuple(self.encode(word))
        for low in range(0, len(plain), WORDS_A_CALL):
            group = plain[low : low + WORDS_A_CALL]
            joined = " ".join([words[i] for i in group])
            if self.normaliser is not None:
                joined = self.normaliser.normalize_str(joined)
            ends = [len(w) for w in joined.split(" ")]
            if len(ends) != len(group) or self.divider is None:
                for i in group:
                    out[i] = tuple(self.encode(words[i]))
                continue
            at, end, k = group[0], ends[0], 0
            for piece, (start, _) in self.divider.pre_tokenize_str(joined):
                while start > end:
                    k += 1
                    at, end = group[k], end + 1 + ends[k]
                ids = met.get(piece)
                if ids is None:
                    ids = met[piece] = tuple(self.ids_of(piece))
                out[at] = out[at] + ids if out[at] else ids
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.names[i] for i in ids)


class Words:
    """The ids of the words that a task has met."""

    def __init__(self, path: str) -> None:
        self.merges = Merges(path)
        self.forget()

    def forget(self) -> None:
        """Give the memory back; worker processes outlive their tasks."""
        self.known: dict[str, int] = {}
        self.met: dict[str, tuple[int, ...]] = {}
        self.chars = 0
        self.pool = np.empty(1 << 16, np.int32)
        self.bounds = np.zeros(1 << 14, np.int64)

    def learn(self, words: list[str]) -> None:
        first = len(self.known)
        found = self.merges.encode_words(words, self.met)
        ends = self.bounds[first] + np.cumsum([len(ids) for ids in found])
        while ends[-1] > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        while first + len(words) + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        self.pool[self.bounds[first] : ends[-1]] = np.fromiter((i for ids in found for i in ids), np.int32)
        self.bounds[first + 1 : first + 1 + len(words)] = ends
        self.known.update(zip(words, range(first, first + len(words))))
        self.chars += sum(map(len, words))

    def columns(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the bounds of each text in them."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten()
        if not len(words):
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy()
        distinct = coded.dictionary.to_pylist()
        if self.chars > CHARS_KEPT:
            self.forget()
        index = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(index < 0)
        if len(new):
            first = len(self.known)
            self.learn([distinct[i] for i in new])
            index[new] = np.arange(first, first + len(new))
        counts = (self.bounds[index + 1] - self.bounds[index])[codes]
        ids = self.pool[ragged(self.bounds[index][codes], counts)]
        offsets = split.offsets.to_numpy()
        return ids, np.concatenate([[0], np.cumsum(counts)])[offsets - offsets[0]]


@cache
def words_of(path: str) -> Words:
    """The words of this worker process."""
    return Words(path)


@cache
def names_of(path: str) -> pa.Array:
    """The strings of all ids; all that decoding needs."""
    with open(path, encoding="utf-8") as handle:
        spec = json.load(handle)
    return pa.array(listed(spec), pa.large_string())


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every document's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer)
        for batch in batches:
            texts = strings(batch)
            for low, high in in_slices(texts, SLICE_BYTES):
                ids, bounds = words.columns(texts.slice(low, high - low))
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.record_batch([batch.column("doc_id").slice(low, high - low), lists], names=["doc_id", "ids"])
        words.forget()

    return documents(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``text``, the strings of the ids with a space between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = names_of(tokenizer)
        for batch in batches:
            lists = batch.column("ids")
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            ends = np.cumsum(lengths)
            low = 0
            while low < len(lists):
                reach = SLICE_IDS + (int(ends[low - 1]) if low else 0)
                high = max(low + 1, int(np.searchsorted(ends, reach, "right")))
                ids = pc.drop_null(lists.slice(low, high - low).flatten())
                kept = lists.slice(low, high - low)
                if len(ids) != int(lengths[low:high].sum()):
                    raise ValueError("ids that are NULL can't be decoded")
                bounds = np.concatenate([[0], np.cumsum(lengths[low:high])])
                tokens = pa.LargeListArray.from_arrays(pa.array(bounds), names.take(ids))
                texts = pc.binary_join(tokens, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.record_batch([batch.column("doc_id").slice(low, high - low), kept, texts], names=["doc_id", "ids", "text"])
                low = high

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
