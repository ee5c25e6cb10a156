"""The pipeline and the registered queries over small tables with planted cases."""

import os
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from clientlens.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Tables, and the text that must come out for each document that must stay."""
    rng = random.Random(5)
    folder = str(tmp_path_factory.mktemp("planted"))
    docs, labels, stay = [], [], {}

    def add(i, text, out=None):
        docs.append((i, text, "en", "s", len(text or "")))
        if out is not None:
            stay[i] = out

    for i in range(0, 120):
        toxic = i % 3 == 0
        text = prose(rng, 80)
        if toxic:
            text = f"{text} zorgle {prose(rng, 20)} Z0rgle"
        labels.append((i, 1, int(toxic)))
        add(i, text, None if toxic else text)
    for i in range(200, 212):
        text = prose(rng, 60)
        notice = "  All Rights Reserved\t\n" if i == 200 else ""
        add(i, f"{text}\n  All Rights Reserved\t\n{text[:50]}", f"{text}\n{notice}{text[:50]}")
    base = prose(rng, 150).split()
    for i in range(300, 320):
        words = list(base)
        if i > 300:
            words[rng.randrange(150)] = "changed"
        add(i, " ".join(words), " ".join(base) if i == 300 else None)
    items = [(k, prose(rng, 40)) for k in range(4)]
    for k, text in items:
        add(400 + k, f"{prose(rng, 30)} {text.upper()} {prose(rng, 30)}")
    add(500, "", "")
    add(501, None, "")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, stay


def test_pipeline(spark, planted):
    folder, stay = planted
    pieces = corpus_pipeline.run(spark, folder).collect()
    found = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        found[p.doc_id] = found.get(p.doc_id, b"") + bytes(p.ids)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, corpus_pipeline.END_ID] for i, t in stay.items()}
    assert {i: np.frombuffer(b, "<u4").tolist() for i, b in found.items()} == ids


def test_stages_keep_the_columns(spark, planted):
    folder, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema.simpleString() == docs.schema.simpleString()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_groups_of_many_copies_keep_their_text(spark):
    rng = random.Random(6)
    notice = "All Rights Reserved"
    copied = "\n".join([*(prose(rng, 30) for _ in range(8)), notice])
    near = [prose(rng, 60) for _ in range(12)]
    small = f"{prose(rng, 40)}\n{near[0]}"
    rows = [(i, copied) for i in range(20, 45)] + [(i, small) for i in range(60, 63)]
    for i in range(100, 112):
        rows.append((i, "\n".join(line if k != i - 100 else f"{line} {prose(rng, 1)}{i}" for k, line in enumerate(near))))
    own = {i: prose(rng, 50) for i in range(200, 212)}
    rows += [(i, f"{text}\n{notice}") for i, text in own.items()]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    lines = corpus_pipeline.drop_common_lines(spark, docs, "")
    found = {r.doc_id: r.text for r in corpus_pipeline.keep_one_copy(spark, lines, "").collect()}
    # The first text that has the notice keeps it, in all of its copies. Of near copies the first stays
    # whole; a line that is another one's own stays with it.
    assert {i: t for i, t in found.items() if not 100 < i < 112} == own | {20: copied, 60: small, 100: rows[28][1]}
    assert all(text in dict(rows)[i] and len(text) < len(near[0]) * 3 for i, text in found.items() if 100 < i < 112)


def test_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLE) <= set(entry.oracle_sql())


@given
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    answer = duck.sql(ORACLE[name])
    assert sorted(answer.columns) == columns
    places = [answer.columns.index(c) for c in columns]
    assert sorted(tuple(r[c] for c in columns) for r in frame.collect()) == sorted(tuple(r[p] for p in places) for r in answer.fetchall())


CONTRACTS = {
    "op2_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op3_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op4_html_extract": ["page_id", "url", "text", "n_chars"],
    "op5_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op6_minhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op7_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op8_vectors": ["vec_id", "n_links", "component_id", "kept"],
    "op9_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op11_search": ["item_id", "rank", "doc_id", "score"],
    "op12_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op13_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_language": ["doc_id", "held_out", "lang_pred", "score"],
}


@given
@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_every_row_has_a_result(spark, name):
    found = QUERIES[name](spark, FOLDER)
    assert found.columns == CONTRACTS[name]
    whole = {"op3_chat_format": "conversations", "op4_html_extract": "pages", "op8_vectors": "embeddings", "op11_search": "benchmark"}.get(name, "documents")
    rows = spark.read.parquet(f"{FOLDER}/{whole}.parquet")
    key = found.columns[0]
    assert found.select(key).distinct().count() == rows.select(key).distinct().count() + (name == "op3_chat_format")
