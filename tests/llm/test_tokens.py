"""Token files and packing against the tokenizers library, encoded text by text."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from clientlens.llm import packing, token_files
from clientlens.llm.common import Files
from clientlens.llm.tokenize import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    "Plain words, and more words.",
    None,
    "",
    "  \n\t ",
    "It's 10 o'clock <|endoftext|>x don't. ß, É. İstanbul ΣΑΣ",
    "é J̌ a\x1cb\u0085c d . , .. abc., 's",
    "word " * 9000,
    "long" * 5000,
    "Plain words, and more words.",
]


def ids_of(text, end):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_encoder_equals_the_library():
    texts = pa.array([t or "" for t in TEXTS], pa.large_string())
    encoder = Encoder(PATH)
    for _ in range(2):
        ids, bounds = encoder.columns(texts)
        for text, low, high in zip(TEXTS, bounds[:-1], bounds[1:]):
            assert ids[low:high].tolist() == ids_of(text, 1)[:-1].tolist()


def test_encoder_forgets_without_harm(monkeypatch):
    monkeypatch.setattr("clientlens.llm.tokenize.WORDS_KEPT", 3)
    encoder = Encoder(PATH)
    for text in ("one two three four", "two five six seven", "one two"):
        assert encoder.columns(pa.array([text], pa.large_string()))[0].tolist() == ids_of(text, 1)[:-1].tolist()


@pytest.fixture
def rows(docs_of):
    return docs_of(*enumerate(TEXTS), (None, "no id"), (4, "a second text of 4"), (4, "a second text of 4"))


def test_files_read_back(spark, rows):
    folder, manifest = token_files.write_shards(rows, PATH, end_id=1, sequence_length=64)
    found = [tuple(r) for r in token_files.read_documents(folder, manifest).collect()]
    wanted = [(None, "no id"), *enumerate(TEXTS), (4, "a second text of 4"), (4, "a second text of 4")]
    expected = sorted((-1 if i is None else i, len(ids_of(t, 1)), zlib.crc32(ids_of(t, 1))) for i, t in wanted)
    assert sorted((-1 if i is None else i, n, crc) for i, _, n, crc in found) == expected
    by_start = sorted(found, key=lambda r: r[1])
    at = 0
    for _, start, n, _ in by_start:
        assert start == at
        at += n
    ids = [-1 if r[0] is None else r[0] for r in by_start]
    assert ids == sorted(ids)


def test_any_sequence_without_the_others(rows):
    folder, manifest = token_files.write_shards(rows, PATH, end_id=1, sequence_length=64)
    files = Files(folder)
    for shard in manifest.collect():
        last = (shard.n_tokens - 1) // 64
        ids, mask = token_files.sequence(files, shard.name, last)
        assert len(ids) == len(mask) == 64 and ids.type == pa.uint16()
        assert sum(mask.to_pylist()) == shard.n_tokens - 64 * last


def check_pieces(pieces, texts, end, capacity):
    ids = {i: ids_of(t, end) for i, t in texts}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        own = ids[p.doc_id][p.start : p.start + p.length]
        assert len(own) == p.length > 0 and zlib.crc32(own) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id])
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(by_doc) == set(ids)
    for groups, full in ((by_doc, None), (by_sequence, capacity)):
        for key, spans in groups.items():
            at = 0
            for start, length in sorted(spans):
                assert start == at
                at += length
            assert at <= full if full else at == len(ids[key])
    return by_sequence


def test_packing_is_whole_and_tight(docs_of):
    rng = np.random.default_rng(3)
    texts = [(i, "word " * int(n)) for i, n in enumerate(rng.integers(0, 700, 400))] + [(900, None), (901, "x " * 5000)]
    pieces = packing.pack_documents(docs_of(*texts), PATH, 2, capacity=256).collect()
    sequences = check_pieces(pieces, texts, 2, 256)
    total = sum(p.length for p in pieces)
    assert len(sequences) * 256 - total < 0.02 * total
    assert all(np.frombuffer(p.ids, "<u4").size == p.length for p in pieces)


def test_packing_joins_what_workers_leave(docs_of):
    texts = [(i, "word " * (3 + i % 5)) for i in range(60)]
    pieces = packing.pack_documents(docs_of(*texts).repartition(12), PATH, 2, capacity=64).collect()
    sequences = check_pieces(pieces, texts, 2, 64)
    assert len(sequences) <= -(-sum(p.length for p in pieces) // 64) + 2


def test_cut_and_best_fit():
    lengths = np.array([1, 63, 64, 65, 100, 2048, 2049, 4095, 4096, 4097, 100_000])
    doc, start, length = packing.cut(lengths)
    assert np.bincount(doc, length).tolist() == lengths.tolist()
    assert (length <= packing.CAPACITY).all() and np.bincount(doc).max() <= 28
    sequence, offset = packing.best_fit([5, 3, 7, 2, 2, 1], 10)
    used = {}
    for s, o, n in sorted(zip(sequence, offset, [5, 3, 7, 2, 2, 1])):
        assert used.get(s, 0) == o
        used[s] = o + n
    assert used == {0: 10, 1: 10} or (max(used.values()) <= 10 and len(used) == 2)


def test_nothing(no_docs):
    assert token_files.read_documents(*token_files.write_shards(no_docs, PATH, 1)).count() == 0
    assert packing.pack_documents(no_docs, PATH, 2).count() == 0
