"""Benchmark passages against a full table of edits."""

import random

import numpy as np
import pytest

from clientlens.llm import decontaminate as dc


def fewest_edits(text, item):
    """Edits of the best occurrence of ``item`` anywhere in ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        now = [i + 1]
        for j, d in enumerate(text):
            now.append(min(row[j] + (c != d), row[j + 1] + 1, now[-1] + 1))
        row = now
    return min(row)


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("xyz")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("xyz"))
    return "".join(out)


def words(rng, n):
    return " ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(2, 7))) for _ in range(n))


def test_alignment_equals_the_full_table():
    rng = random.Random(1)
    for _ in range(150):
        text = [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
        item = [rng.randrange(3) for _ in range(rng.randrange(2, 12))]
        found = dc.align(np.array(text, np.uint32), np.array(item, np.uint32), -len(item), len(text), len(item) - 1)
        best = fewest_edits(text, item)
        assert min((e for *_, e in found), default=len(item)) == min(best, len(item))
        assert all(fewest_edits(text[a:b], item) <= e for a, b, e in found)


def test_no_occurrence_within_the_budget_is_lost():
    rng = random.Random(2)
    items = [(i, words(rng, rng.randrange(8, 60))) for i in range(12)]
    block = dc.index(items)
    for i, text in items:
        budget = int(len(text) * dc.EDITS)
        for n in (0, budget // 2, budget, 3 * budget):
            inside = edited(rng, text, n)
            found = {x[0] for x in dc.occurrences(f"{words(rng, 20)} {inside} {words(rng, 20)}", block)}
            if fewest_edits(inside, text) <= budget:
                assert i in found
            assert found <= {i}


def test_every_quote_of_the_least_length_is_found():
    rng = random.Random(7)
    item = words(rng, 500)
    block = dc.index([(1, item), (2, words(rng, 40))])
    around = words(rng, 30), words(rng, 30)
    for at in [*range(0, len(item) - dc.QUOTE, 13), len(item) - dc.QUOTE]:
        found = {x[0] for x in dc.occurrences(f"{around[0]} {item[at : at + dc.QUOTE]} {around[1]}", block)}
        assert found == {1}, at
    for at in range(0, 450, 50):
        quote = " ".join(item.split()[at : at + 50])
        assert len(quote) >= dc.QUOTE and {x[0] for x in dc.occurrences(f"{around[0]} {quote} {around[1]}", block)} == {1}
    assert not list(dc.occurrences(f"{around[0]} {around[1]}", block))
    whole = list(dc.occurrences(f"{around[0]} {item} {around[1]}", block))
    assert len(whole) == len(list(dc.windows(np.arange(len(item)), dc.WINDOW))) and all(x[3] == 0 for x in whole)


@pytest.fixture
def benchmark(spark):
    rng = random.Random(3)
    items = [(1, words(rng, 40)), (2, words(rng, 30)), (3, "tiny"), (4, None), (5, ""), (None, words(rng, 30)), (6, words(rng, 300))]
    return spark.createDataFrame([(*x, "x") for x in items], "item_id long, text string, doc_id string"), dict(items)


def test_documents(docs_of, benchmark):
    frame, items = benchmark
    rng = random.Random(4)
    clean = words(rng, 200)
    part = items[6][200:1100]
    rows = [
        (10, f"{clean} {items[1].upper()}\n\n{clean}"),
        (11, items[2].replace(" ", "\n\t ")),
        (12, clean),
        (13, None),
        (14, ""),
        (15, f"{items[1]} {items[1]} tiny"),
        (16, f"{clean} {part} {clean}"),
        (17, clean * 100 + edited(rng, items[2], 5)),
        (None, items[2]),
        (11, clean),
    ]
    docs = docs_of(*rows)
    found = dc.contaminated(docs, frame).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(10, 1), (11, 2), (15, 1), (16, 6), (17, 2), (None, 2)}
    assert sum(r.doc_id == 15 for r in found) == 2
    text = dict(rows[:-1])
    whole = next(r for r in found if r.doc_id == 10)
    assert text[10][whole.begin : whole.end] == items[1].upper() and whole.edits == 0
    clean_ones = dc.clean_documents(docs, frame)
    assert clean_ones.columns == docs.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in clean_ones.collect()) == [11, 12, 13, 14]


def test_blocks_give_the_same(docs_of, benchmark, monkeypatch):
    frame, items = benchmark
    docs = docs_of((1, f"a {items[1]} b {items[2]}"), (2, items[6]))
    one = sorted(tuple(r) for r in dc.contaminated(docs, frame).collect())
    monkeypatch.setattr(dc, "BLOCK_CHARS", 500)
    assert sorted(tuple(r) for r in dc.contaminated(docs, frame).collect()) == one
    monkeypatch.setattr(dc, "MOST_CHARS", 8000)
    assert sorted(tuple(r) for r in dc.contaminated(docs, frame).collect()) == one


def test_an_item_beyond_a_part(spark, docs_of, monkeypatch):
    monkeypatch.setattr(dc, "PART_CHARS", 4000)
    monkeypatch.setattr(dc, "BLOCK_CHARS", 8000)
    rng = random.Random(11)
    item = words(rng, 5000).replace(" ", " \n\t ")
    frame = spark.createDataFrame([(1, item), (2, words(rng, 40))], "item_id long, text string")
    assert dc._items(frame).agg({"text": "count"}).first()[0] > 5
    flat = " ".join(item.split())
    docs = [(at, f"{words(rng, 20)} {flat[at : at + dc.QUOTE]} {words(rng, 20)}") for at in range(0, len(flat) - dc.QUOTE, 397)]
    docs.append((-1, words(rng, 300)))
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(docs_of(*docs), frame).collect()}
    assert found == {(i, 1) for i, _ in docs if i >= 0}


@pytest.mark.parametrize("stretch", [1, 7, 400])
def test_stretches_give_the_same_bands(stretch, monkeypatch):
    rng = random.Random(12)
    common = words(rng, 12)
    items = [(i, f"{words(rng, 15)} {common} {words(rng, 15 + 40 * (i % 4))}") for i in range(20)]
    block = dc.index(items)
    text = " ".join(f"{common} {words(rng, 5)} {edited(rng, items[rng.randrange(20)][1], 3)}" for _ in range(30))
    points = dc.normalised(text)[0]
    whole = dc.bands(points, block)
    monkeypatch.setattr(dc, "STRETCH", stretch)
    assert whole and dc.bands(points, block) == whole


def test_a_long_text_of_one_common_gram(docs_of, spark):
    frame = spark.createDataFrame([(i, "spam " * 20 + f"{i} " * 30) for i in range(5)], "item_id long, text string")
    rng = random.Random(13)
    docs = docs_of((1, "spam " * 400), (2, words(rng, 50)))
    assert {r.doc_id for r in dc.contaminated(docs, frame).collect()} <= {1}


def test_rows_are_dropped_one_by_one(docs_of, benchmark):
    frame, items = benchmark
    docs = docs_of((1, f"a {items[1]} b"), (1, "clean"), (1, None), (None, items[2]), (None, "clean"), (2, items[2]), (2, items[2]))
    docs = docs.selectExpr("*", "1 AS key", "2 AS id", "3 AS row")
    kept = dc.clean_documents(docs, frame)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, "clean"), (1, ""), (1, "clean")]


def test_repeated_items_are_measured_once(spark, docs_of, monkeypatch):
    text = words(random.Random(8), 30)
    frame = spark.createDataFrame([(1, text)] * 40, "item_id long, text string")
    monkeypatch.setattr(dc, "MOST_CHARS", 2 * len(text))
    assert [(r.doc_id, r.item_id) for r in dc.contaminated(docs_of((5, f"a {text} b")), frame).collect()] == [(5, 1)]


def test_items_without_id_count(docs_of, benchmark):
    frame, items = benchmark
    docs = docs_of((1, f"a {items[None]} b"), (2, "a b"), (3, items[1]))
    assert sorted((r.doc_id, r.item_id or -1) for r in dc.contaminated(docs, frame).collect()) == [(1, -1), (3, 1)]
    assert [r.doc_id for r in dc.clean_documents(docs, frame).collect()] == [2]


def test_nothing(no_docs, benchmark):
    frame, _ = benchmark
    assert dc.contaminated(no_docs, frame).count() == 0
    assert dc.contaminated(no_docs, frame.limit(0)).count() == 0
