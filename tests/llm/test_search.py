import math
import random
import re
import string
from collections import Counter

import pytest

from clientlens.llm import search

SMALL = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def plainly(docs, items, best=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    rows = []
    for item_id, text in set(items):
        scored = []
        for doc_id, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id, score))
        for rank, (*_, doc_id, score) in enumerate(sorted(scored, key=lambda s: s[:3])[:best], 1):
            rows.append((item_id, rank, doc_id, score))
    return sorted(rows, key=str)


def found(spark, docs_of, docs, items, best=10):
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS term", "'x' AS block", "'x' AS item")
    rows = search.search(docs_of(*docs), benchmark, best).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=str)


def texts_of(pick, n, words):
    # A few words are in nearly every text, most in few.
    weights = [1 / (k + 1) for k in range(len(words))]
    return [" ".join(pick.choices(words, weights, k=pick.choice([0, 3, 20, 90]))) for _ in range(n)]


@pytest.mark.parametrize("blocks", [4096, 7])
def test_all_documents_against_brute_force(spark, docs_of, blocks, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_DOCS", blocks)
    pick = random.Random(11)
    words = [f"w{k}" for k in range(150)] + ["Été", "x-y", "_a", "9", "日本"]
    docs = list(enumerate(texts_of(pick, 400, words)))
    items = [(i, t) for i, t in enumerate(texts_of(pick, 30, words))]
    assert found(spark, docs_of, docs, items) == plainly(docs, items)


def test_many_bundles_and_the_join_without_broadcast(spark, docs_of, monkeypatch):
    pick = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    docs, items = list(enumerate(texts_of(pick, 90, words))), list(enumerate(texts_of(pick, 300, words)))
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    assert found(spark, docs_of, docs, items, 3) == plainly(docs, items, 3)


def test_nulls_ties_and_repeated_rows(spark, docs_of):
    docs = [(5, "a b"), (4, "a b"), (None, "a b"), (4, "a b"), (6, None), (7, ""), (8, "-- ..."), (9, "a " * 30_000), (10, "A\x0bb!")]
    items = [(1, "a b"), (1, "a b"), (1, "b"), (None, "a, a"), (2, None), (3, "!"), (4, "unknown")]
    assert found(spark, docs_of, docs, items) == plainly(docs, items)
    assert found(spark, docs_of, docs, items, 2) == plainly(docs, items, 2)


def test_no_rows(spark, docs_of, no_docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert search.search(no_docs, spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []
    assert search.search(docs_of((1, "a")), empty).collect() == []
    assert search.search(docs_of((1, "-"), (2, None)), spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []
