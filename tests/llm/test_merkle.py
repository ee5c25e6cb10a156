import hashlib
import random
import zlib

import pytest

from clientlens.llm import merkle
from clientlens.llm.queries import QUERIES

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc, text):
    values = [None if v is None else str(v) for v in (doc[0], doc[1], doc[2], doc[3], text)]
    return H(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree_of(nodes):
    """The root of a list of nodes, and each node's siblings as (before, after) for each level."""
    proofs, level, spans = [[] for _ in nodes], list(nodes), [[i] for i in range(len(nodes))]
    while len(level) > 1:
        upper, upper_spans = [], []
        for low in range(0, len(level), 16):
            run = level[low : low + 16]
            for i in range(len(run)):
                for at in spans[low + i]:
                    proofs[at].append(("".join(run[:i]), "".join(run[i + 1 :])))
            upper.append(H(*run))
            upper_spans.append([at for s in spans[low : low + 16] for at in s])
        level, spans = upper, upper_spans
    return level[0], proofs


def plainly(docs):
    by_source = {}
    for doc in docs:
        by_source.setdefault(doc[1], []).append(doc)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    roots, inside = [], []
    for source in sources:
        own = sorted(by_source[source], key=lambda d: (d[0] is not None, d[0] or 0, leaf_of(d, d[4])))
        root, proofs = tree_of([leaf_of(d, d[4]) for d in own])
        roots.append(root)
        inside.append((own, proofs))
    root, above = tree_of(roots)
    rows = []
    for (own, proofs), subroot, rest in zip(inside, roots, above):
        for doc, proof in zip(own, proofs):
            whole, text = proof + rest, doc[4]
            if doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf_of(doc, text)
            for before, after in whole:
                node = H(before, node, after)
            rows.append((doc[0], leaf_of(doc, doc[4]), subroot, root, H(*(b + a for b, a in whole)), node, node == root))
    return rows


def found(spark, docs, folder):
    frame = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    clashing = frame.selectExpr("*", *(f"'x' AS {c}" for c in ("tree", "place", "row", "n", "leaf", "range", "at", "block", "root")))
    clashing.write.parquet(f"{folder}/documents.parquet")
    rows = QUERIES["op12_merkle"](spark, str(folder))
    return [tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in rows.collect()]


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [256, 1], [257, 3], [1, 0, 700, 30], [2] * 40])
def test_any_number_of_rows(spark, sizes, tmp_path):
    pick = random.Random(sum(sizes))
    ids = pick.sample(range(10_000), sum(sizes))
    docs = []
    for k, size in enumerate(sizes):
        for _ in range(size):
            docs.append((ids.pop(), f"s{k}", pick.choice(["en", None]), pick.choice([5, None]), pick.choice(["Ab", "cd", "", None, "ÉA"])))
    assert sorted(found(spark, docs, tmp_path)) == sorted(plainly(docs))


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    docs = [
        (None, None, None, None, None),
        (None, None, None, None, None),
        (None, "", "", 0, ""),
        (7, "b", "en", 1, "A"),
        (7, "b", "en", 1, "A"),
        (7, "b", "en", 1, "B"),
        (8, "-", "en", 1, "C" * 50_000),
        (9, "\U0001f600", "en", 1, "D"),
        (10, "￿", "en", 1, "E"),
        (-3, "b", "en", 1, "F"),
    ]
    key = lambda rows: sorted(rows, key=str)
    assert key(found(spark, docs, tmp_path)) == key(plainly(docs))


def test_no_rows(spark, tmp_path):
    assert found(spark, [], tmp_path) == []


def test_a_changed_text_is_noticed(spark, docs_of):
    docs = docs_of((1, "Some text"), (2, "more"), (3, None))
    proven = merkle.manifest(docs)
    read = proven.select("doc_id", "root", "proof", merkle.folded(proven.leaf, proven.proof).alias("whole")).collect()
    assert all(row.whole == row.root for row in read)
    forged = proven.select("root", merkle.folded(merkle.F.sha2(proven.leaf, 256), proven.proof).alias("whole")).collect()
    assert all(row.whole != row.root for row in forged)


def test_ranges_are_drawn_from_stored_digests(spark, docs_of, monkeypatch):
    plans, rank = [], merkle.ranked

    def watched(nodes, *order):
        plans.append(nodes._jdf.queryExecution().executedPlan().toString())
        return rank(nodes, *order)

    monkeypatch.setattr(merkle, "ranked", watched)
    assert merkle.manifest(docs_of((1, "a"), (2, "b"), (3, None))).count() == 3
    # Ranking reads its input twice, for the sample and for the rows.
    assert len(plans) == 2 and not any("sha2" in p for p in plans)
