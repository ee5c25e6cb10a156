"""Near-duplicate vectors against all pairs in double precision."""

import math

import numpy as np
import pytest

from clientlens.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, rep string, n string"


def brute(rows, threshold):
    usable = {}
    for k, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[k] = np.array(v, "f4").astype("f8")
    links, root = [0] * len(rows), {k: k for k in usable}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    def join(a, b):
        p, q = sorted((top(a), top(b)), key=lambda k: rows[k][0])
        root[q] = p

    for a in usable:
        for b in usable:
            if a < b and rows[a][2] == rows[b][2] and len(usable[a]) == len(usable[b]):
                x, y = usable[a], usable[b]
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                    links[a], links[b] = links[a] + 1, links[b] + 1
                    join(a, b)
            if a < b and rows[a][0] == rows[b][0]:
                join(a, b)
    return sorted(((-1 if i is None else i), links[k], -1 if i is None else rows[top(k)][0] if k in usable else i) for k, (i, *_) in enumerate(rows))


@pytest.mark.parametrize("block, tile", [(4096, 1024), (20, 7)])
def test_links(spark, monkeypatch, block, tile):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(12):
        base = rng.normal(size=16)
        for scale in (0, 0, 0.02, 0.05, 0.1, 0.15, 0.2):
            rows.append((base + scale * rng.normal(size=16)).tolist())
    rows = [(i, v, int(rng.integers(0, 2))) for i, v in enumerate(rows)]
    one = [1.0] + [0.0] * 15
    rows += [(200 + i, one, 0) for i in range(9)] + [(300, [2.5 * x for x in one], 0), (301, [-0.0 if not x else x for x in one], 0)]
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [None] * 16, 0), (404, [math.nan] * 16, 0), (405, [math.inf] * 16, 0)]
    rows += [(406, one, None), (None, one, 0), (407, [1.0], 0), (408, [2.0], 0), (409, [1e38] * 16, 1), (410, [1e-38] * 16, 1)]
    frame = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)
    found = vectors.near_duplicates(frame, 0.98).collect()
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id) for r in found)
    assert got == brute(rows, 0.98)
    assert all(r.kept == (r.component_id is None or r.vec_id == r.component_id) for r in found)


def test_ids_with_several_vectors(spark):
    v, w, u = ([float(i == k) for i in range(4)] for k in range(3))
    rows = [(1, v, 0), (5, v, 0), (5, w, 0), (7, w, 0), (9, u, 0), (9, v, 1), (9, w, 1), (11, v, 1), (12, None, 0), (12, u, 0), (5, w, 0)]
    found = vectors.near_duplicates(spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA), 0.98).collect()
    # The row without a vector stays alone.
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == brute(rows, 0.98)
    assert {r.vec_id: r.component_id for r in found if r.n_links}[7] == 1


def test_bound_holds():
    rng = np.random.default_rng(2)
    units = vectors.unit(rng.normal(size=(300, 64)) * np.exp(rng.normal(size=(300, 1))))
    whole, step, off = vectors.quantised(units)
    nearly = vectors.products(whole, whole) * step[:, None] * step
    bound = off[:, None] + off + off[:, None] * off
    assert (np.abs(nearly - units @ units.T) <= bound).all() and bound.max() < 0.1


def test_products_are_exact_for_long_vectors():
    whole = np.full((2, 5000), 127, np.int8)
    assert (vectors.products(whole, whole) == 127 * 127 * 5000).all()


def test_nothing(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
