"""Near duplicates against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clientlens.llm import minhash
from clientlens.llm.components import components
from clientlens.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width):
    words = WORD.findall((text or "").translate(SMALL))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, percent):
    """Component of each id; rows that share an id are one document with several texts."""
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text, width))
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def mutated(rng, words, share):
    return " ".join(w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in words)


def corpus(rng):
    """Copies, near copies from close to far, chains, and texts alone."""
    rows = []
    for group in range(4):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(40, 160))]
        rows += [mutated(rng, words, share) for share in (0, 0, *(rng.random() * 0.08 for _ in range(25)))]
        for _ in range(12):
            words = mutated(rng, words, 0.02).split()
            rows.append(" ".join(words))
    rows += [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 60))) for _ in range(20)]
    rows += [None, "", " \n ", "one", "One", "one two", "ONE\ttwo", "é É", "É É", "a\x85b c d"]
    rng.shuffle(rows)
    return list(enumerate(rows, 5))


@pytest.mark.parametrize("width, percent, seed", [(3, 85, 1), (5, 80, 2)])
def test_components(docs_of, width, percent, seed):
    rows = corpus(random.Random(seed))
    found = minhash.near_duplicates(docs_of(*rows), width, percent).collect()
    want = brute(rows, width, percent)
    assert {r.doc_id: r.component_id for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(shingles(t, width)) for i, t in rows}


def test_repeated_rows_and_rows_without_id(docs_of):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(3, text), (3, text), (3, "other words here now"), (7, text), (None, text), (None, text), (9, "other words here now")]
    found = sorted(tuple(-1 if v is None else v for v in r) for r in minhash.near_duplicates(docs_of(*rows), 3, 85).collect())
    assert [(r[0], r[2], r[3]) for r in found] == [(-1, -1, True)] * 2 + [(3, 3, True)] * 3 + [(7, 3, False), (9, 3, False)]
    kept = minhash.keep_one(docs_of(*rows), 3, 85)
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 3] and "nth" in kept.columns


def test_what_members_can_have_in_common(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d x e"), (3, "a b c y x f"), (4, "q r s"), (5, "a b z c d f")]
    texts = spark.createDataFrame(rows, "rep long, text string")
    tried = spark.createDataFrame([(1, 2, 9), (1, 3, 9), (1, 5, 9), (4, 5, 2)], "a long, b long, weight long")
    members = spark.createDataFrame([(2,), (3,), (4,), (5,)], "rep long")
    facts = minhash.overlaps(members, tried, texts, 1).cache()
    found = {r.rep: (r.alone, r.centre, r.whole, r.common) for r in facts.collect()}
    # x is shared by 2 and 3, y and z are one's own; all of 4 is its own, and it has no centre.
    assert found == {2: (0, 1, 6, 5), 3: (1, 1, 6, 4), 4: (3, None, None, None), 5: (1, 1, 6, 5)}
    sets = {i: set(t.split()) for i, t in rows}
    own = facts.selectExpr("*", "size(lacks) AS n").withColumns({"size": F.when(F.col("rep") == 4, 3).otherwise(6)})
    own = own.withColumn("room", F.col("size") - F.col("alone")).withColumn("shared", F.col("room") - F.col("common"))
    pairs = own.select(*(F.col(c).alias(f"x_{c}") for c in own.columns)).join(own, F.col("x_rep") < F.col("rep"))
    bounds = {(r.x_rep, r.rep): r.most for r in pairs.select("x_rep", "rep", minhash.most_in_common("x_", "").alias("most")).collect()}
    assert len(bounds) == 6 and all(len(sets[a] & sets[b]) <= most for (a, b), most in bounds.items())
    assert bounds[3, 5] == 4 == len(sets[3] & sets[5]) and bounds[2, 4] == 0


def test_threshold():
    assert minhash.match_threshold(85) == 3 and minhash.match_threshold(80) == 1
    assert minhash.match_threshold(100) == minhash.COORDINATES


def test_signatures_agree_as_sets_do():
    rng = np.random.default_rng(1)
    base = rng.integers(1, 2**63, 2000, np.uint64)
    a, b = np.unique(base[:1800]), np.unique(base[200:])
    x, y = minhash.signatures([a, b])
    assert 8 <= (x == y).sum() <= 26  # 32 * 0.8 ** 3 is 16
    one = list(shingle_sets(pa.array(["a B c", "A b C", "a b"], pa.large_string()), 3))
    assert (one[0] == one[1]).all() and len(one[2]) == 1 and one[2][0] != one[0][0]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(200, 100 + i) for i in range(20)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (3, 2), (None, 5)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {i: 100 for i in [*range(101, 120), 200]}
    assert components(links.limit(0)).count() == 0


def test_nothing(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.keep_one(no_docs).columns == no_docs.columns
