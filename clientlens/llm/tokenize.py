"""Token ids of whole texts with a public tokenizer file.

The tokenizer of the file drops white space, and neither its normaliser nor its pattern looks
across it. So the ids of a text are those of its words in order, and each distinct word is
encoded once: the words of a slice of rows are dictionary-encoded by Arrow, unknown ones go to
the tokenizers library, and the ids of all rows are gathered with one numpy step.
:func:`check_splits_at_spaces` refuses a file for which this doesn't hold.
"""

from __future__ import annotations

import functools
import os
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import ragged

#: Words kept by a task; the store is emptied when it is full, which costs time only.
WORDS_KEPT = 700_000
#: Words are joined to texts of this many words for the library.
WORDS_A_CALL = 64
#: Marks that are tokens of their own after a plain word, and the last letter of plain words:
#: letters up to here are the same in all editions of Unicode.
MARKS, LAST_PLAIN = ".,", "\u024f"
#: The one letter among them whose small form has a combining mark, which ends a word.
DOTTED = "\u0130"


def check_splits_at_spaces(tokenizer) -> None:
    probe = ["a b", " a  b ", "a\nb", "a\t\r\x0b\x0cb"]
    wanted = [i for w in ("a", "b") for i in tokenizer.encode(w, add_special_tokens=False).ids]
    for text in probe:
        if tokenizer.encode(text, add_special_tokens=False).ids != wanted:
            raise ValueError("this tokenizer file gives white space ids of its own")
    ab, mark = (tokenizer.encode(t, add_special_tokens=False) for t in ("ab", ","))
    if tokenizer.encode("ab,", add_special_tokens=False).ids != ab.ids + mark.ids or not ab.tokens[-1].endswith("</w>"):
        raise ValueError("this tokenizer file doesn't end words with a token of their own")


class Encoder:
    """Encodes columns of texts; keeps the ids of words it has met."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        check_splits_at_spaces(self.library)
        self.vocabulary = self.library.get_vocab_size()
        names = self.library.get_vocab()
        self.ends_word = np.zeros(self.vocabulary, bool)
        self.ends_word[[i for w, i in names.items() if w.endswith("</w>")]] = True
        self.known: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        """Give the memory back; worker processes outlive their tasks."""
        self.known = {}
        self.pool = np.empty(1 << 20, np.uint32)
        self.bounds = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _store(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        first = len(self.known)
        while first + len(words) + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.bounds[first + 1 : first + 1 + len(words)] = self.used + np.cumsum(counts)
        self.used += len(ids)
        self.known.update(zip(words, range(first, first + len(words))))

    def _learn(self, words: list[str]) -> None:
        """Encode new words.

        A plain word and a mark after it have ids of their own, so "word," costs no call once
        "word" is known. Plain words are joined by spaces, and a token that ends a word ends the
        ids of each; the others are told apart by their places in the joined text.
        """
        plain: dict[str, None] = {}
        marked, others = [], []
        for word in words:
            stem = word[:-1] if word[-1:] in MARKS else word
            if not stem.isalpha() or max(stem) > LAST_PLAIN or DOTTED in stem:
                others.append(word)
                continue
            if stem is not word:
                marked.append(word)
            if stem not in self.known:
                plain[stem] = None
        if plain:
            found = self.library.encode_batch_fast(self._joined(list(plain)), add_special_tokens=False)
            ids = np.concatenate([np.array(f.ids, np.uint32) for f in found])
            ends = np.flatnonzero(self.ends_word[ids])
            if len(ends) != len(plain):
                raise ValueError("a plain word has more than one end")
            self._store(list(plain), ids, np.diff(ends, prepend=-1))
        if others or marked:
            others += [m for m in MARKS if m not in self.known and m not in others]
            groups = self._joined(others)
            counts, ids = [], []
            for i, found in enumerate(self.library.encode_batch(groups, add_special_tokens=False)):
                group = others[i * WORDS_A_CALL : (i + 1) * WORDS_A_CALL]
                ends = np.cumsum([len(w) + 1 for w in group])
                places = np.array([a for a, _ in found.offsets], np.int64)
                ids.append(np.array(found.ids, np.uint32))
                counts.append(np.bincount(np.searchsorted(ends, places, "right"), minlength=len(group)))
            if others:
                self._store(others, np.concatenate(ids), np.concatenate(counts))
        if marked:
            pairs = np.array([[self.known[w[:-1]], self.known[w[-1]]] for w in marked]).ravel()
            counts = self.bounds[pairs + 1] - self.bounds[pairs]
            ids = self.pool[ragged(self.bounds[pairs], counts)]
            self._store(marked, ids, counts.reshape(-1, 2).sum(1))

    @staticmethod
    def _joined(words: list[str]) -> list[str]:
        return [" ".join(words[i : i + WORDS_A_CALL]) for i in range(0, len(words), WORDS_A_CALL)]

    def columns(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the bounds of each text in them."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten()
        if not len(words):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) + len(distinct) > WORDS_KEPT:
            self.forget()
        index = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(index < 0)
        if len(missing):
            new = [distinct[i] for i in missing]
            self._learn(new)
            index[missing] = [self.known[w] for w in new]
        starts, ends = self.bounds[index], self.bounds[index + 1]
        counts = (ends - starts)[codes]
        ids = self.pool[ragged(starts[codes], counts)]
        per_word = np.concatenate([[0], np.cumsum(counts)])
        offsets = split.offsets.to_numpy()
        return ids, per_word[offsets - offsets[0]]


@functools.cache
def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    return Encoder(path)


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts, each followed by ``end_id``."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))
