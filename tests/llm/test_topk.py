import math

import numpy as np
import pyarrow as pa

from hearth.llm import op11_topk as op
from tests.llm.helpers import crowded, found

SCHEMA = "vec_id long, embedding array<float>, label int"
COLS = ("query_id", "rank", "vec_id", "score")


def brute(rows, top=5, every=50):
    ok = {(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in rows
          if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for q in sorted({i for i, _ in ok if i % every == 0}):
        best = {}
        for i, x in ok:
            for j, y in ok:
                if i == q and j != q:
                    s = sum(a * b for a, b in zip(x, y))
                    best[j] = max(s, best.get(j, s))
        order = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:top]
        out += [(q, k + 1, j, s) for k, (j, s) in enumerate(order)]
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(12):  # clusters, repeated vectors and ties
        base = rng.normal(size=8)
        for _ in range(rng.integers(5, 30)):
            rows.append((len(rows), [float(c) for c in base + rng.normal(size=8) * 0.05]))
    rows += [(len(rows) + k, rows[3][1]) for k in range(40)]
    rows += [(1000 + k, [0.0] * 8) for k in range(10)]
    got = op.exact_top_k(crowded(table(spark, rows), "x", "ids", "region", "score", "rank", "query_id", "q"),
                         every=5, page=4, shelf=16, region_rows=20)
    assert found(got, *COLS) == brute(rows, every=5)


def test_edge_rows(spark):
    v = [0.5, -0.25, 0.1]
    rows = [(0, v), (0, v), (0, [0.1, 0.1, 0.1]), (1, None), (2, [None, 1.0, 1.0]), (3, [float("nan"), 1.0, 1.0]), (4, [float("inf")] * 3),
            (None, v), (5, []), (6, v[:2]), (7, v + [9.0]), (50, v), (50, v), (100, None), (150, []), (-50, [-0.001] * 3), (8, v), (8, [3.0] * 3)]
    got = op.exact_top_k(table(spark, rows), page=2, shelf=3, region_rows=2)
    assert found(got, *COLS) == brute(rows)
    assert {r["query_id"] for r in got.collect()} == {-50, 0, 50, 150}


def test_empty_tables_and_single_rows(spark):
    assert op.exact_top_k(table(spark, [])).count() == 0
    assert op.exact_top_k(table(spark, [(0, [1.0])])).count() == 0
    assert op.exact_top_k(table(spark, [(1, [1.0]), (2, [2.0])])).count() == 0  # no queries
    assert op.exact_top_k(table(spark, [(0, None), (50, [None])])).count() == 0
    assert found(op.exact_top_k(table(spark, [(0, [1.0]), (3, [2.0])])), *COLS) == [(0, 1, 3, 256 * 512)]
    assert found(op.exact_top_k(table(spark, [(0, []), (3, [])])), *COLS) == [(0, 1, 3, 0)]


def test_huge_components_saturate(spark):
    rows = [(0, [3e38, 1.0]), (1, [3e38, 0.0]), (2, [-3e38, 5.0])]
    got = {(r["vec_id"], r["score"]) for r in op.exact_top_k(table(spark, rows)).collect()}
    assert got == {(1, op.LIMIT ** 2), (2, -op.LIMIT ** 2 + 256 * 1280)}


def test_bounds_avoid_computations():
    """On clustered vectors a shelf's search computes a small part of the scores, and its result is exact."""
    rng = np.random.default_rng(2)
    x = np.floor(256 * np.concatenate([c + rng.normal(size=(100, 16)) * 0.02 for c in rng.normal(size=(20, 16))])).astype(np.int64)
    space = op.Space(float((x.astype(float) ** 2).sum(1).max()), 16)
    made = op.load_pages(x, [[i] for i in range(len(x))], x[0], space, 32)
    assert sum(len(p["distance"]) for p in made) == len(x) and max(len(p["distance"]) for p in made) <= 32
    aug = np.sqrt(np.maximum(0, space.most - space.norms(x)))
    for p in made:  # covering radii and distances hold
        held = np.array(p["x"]).reshape(-1, 16)
        assert np.allclose(space.between(held, np.array(p["center"])[None, :])[:, 0], p["distance"]) and max(p["distance"]) <= p["radius"]
    assert len(aug) == len(x)
    shelf = op.Shelf(pa.Table.from_pylist(made), space)
    computed = 0
    for q in range(0, len(x), 37):
        shelf.computed = 0
        got = shelf.search(x[q], q, float(space.from_query(x[q], x[:1])[0]), None, 5)
        want = sorted((-int(s), i) for i, s in enumerate(x @ x[q]) if i != q)[:5]
        assert got == want
        computed += shelf.computed
    assert computed < 0.5 * len(x) * len(range(0, len(x), 37))


def test_metric_is_a_metric():
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, size=(40, 6))
    space = op.Space(float((x.astype(float) ** 2).sum(1).max()), 6)
    d = space.between(x, x)
    assert np.allclose(d, d.T) and (d[:, :, None] <= d[:, None, :] + d[None, :, :].transpose(0, 2, 1) + 1e-6).all()
    for q in rng.integers(-300, 300, size=(10, 6)):
        order = space.from_query(q, x)
        assert (np.argsort(order, kind="stable")[0] in np.flatnonzero(x @ q == (x @ q).max()))
        assert all(abs(space.of_score(q, int(s)) - e) < 1e-6 for s, e in zip(x @ q, order))
