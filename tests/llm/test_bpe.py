import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from clientlens.llm import bpe
from clientlens.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
MARKS = [
    *"abcdeABC'sS ,.<|>\n\t019",
    *"\u00e9\u00f1\u00d1\u0130\u00a0\u3000\u0301\u65e5\u672c\U0001f600\u00df\u03a3\u03c2",
    "<|endoftext|>",
    "<|startoftext|>",
    "'re",
    "<|",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_random_texts_equal_the_library(library):
    pick = random.Random(13)
    marks = MARKS + [chr(pick.randrange(0x20, 0x2FFF)) for _ in range(300)]
    texts = ["".join(pick.choices(marks, k=pick.randrange(60))) for _ in range(3000)]
    words = bpe.Words(PATH)
    ids, bounds = words.columns(pa.array(texts, pa.large_string()))
    for i, text in enumerate(texts):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == wanted
        assert words.merges.decode(wanted) == library.decode(wanted, skip_special_tokens=False)


def merged_plainly(symbols, ranks, given):
    """The lowest rank first, the leftmost of equals, by looking at all pairs each time."""
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not found:
            return symbols
        rank, at = min(found)
        symbols = [*symbols[:at], given[rank], *symbols[at + 2 :]]


def test_merges_equal_a_plain_search():
    merges, pick = bpe.Merges(PATH), random.Random(7)
    for _ in range(400):
        word = "".join(pick.choices("aabeinorst", k=pick.randrange(1, 40)))
        marks = [merges.vocabulary[c] for c in word[:-1]] + [merges.vocabulary[word[-1] + "</w>"]]
        assert merges.merge(list(marks)) == merged_plainly(marks, merges.ranks, merges.given)
    assert merges.merge([]) == []


def test_a_long_word_is_merged_in_little_time(library):
    text = "ab" * 100_000
    assert bpe.Merges(PATH).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_documents(spark, docs_of, no_docs, library):
    said = {1: "Hello, World! hello", 2: None, 3: "", 4: " \n\u00a0 ", 5: "a " * 3000, None: "x<|endoftext|>y"}
    docs = docs_of(*said.items(), (1, "Hello, World! hello"))
    found = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(found) == 7
    for row in found:
        wanted = library.encode(said[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == wanted and row.text == library.decode(wanted, skip_special_tokens=False)
    assert bpe.encode(no_docs, PATH).collect() == []
    nothing = spark.sql("SELECT 1L AS doc_id, CAST(NULL AS array<int>) AS ids")
    assert bpe.decode(nothing, PATH).first().text == ""
    with pytest.raises(Exception, match="NULL"):
        bpe.decode(spark.sql("SELECT 1L AS doc_id, array(1, NULL) AS ids"), PATH).collect()


def test_small_slices_and_forgetting_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CHARS_KEPT", 50)
    words, pick = bpe.Words(PATH), random.Random(3)
    for _ in range(20):
        texts = [" ".join(pick.choices(["alpha", "beta", "gamma", "x1", "", "delta9,"], k=9)) for _ in range(5)]
        ids, bounds = words.columns(pa.array(texts, pa.large_string()))
        for i, text in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids


def test_query(spark, docs_of, library, tmp_path):
    said = {1: "Hello, World!", 2: None, 3: "naive caf\u00e9 <|endoftext|>"}
    docs_of(*said.items()).write.parquet(str(tmp_path / "documents.parquet"))
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for row in QUERIES["op13_bpe"](spark, str(tmp_path)).collect():
        ids = library.encode(said[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == digest(" ".join(map(str, ids)))
        assert row.decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))
