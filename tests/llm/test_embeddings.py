import random

import numpy as np

from hearth.llm import op5_embeddings as op
from tests.llm.helpers import crowded

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    ok = [(i, np.array(v, np.float32).astype(float), g) for i, v, g in rows
          if g is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    links, parent = {k: 0 for k in range(len(ok))}, list(range(len(ok)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(ok)):
        for b in range(a):
            x, y = ok[a][1], ok[b][1]
            if ok[a][2] == ok[b][2] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _, _) in enumerate(ok):
        low[find(k)] = min(i, low.get(find(k), i))
    out = [(i, links[k], low[find(k)]) for k, (i, _, _) in enumerate(ok)]
    rest = [i for i, v, g in rows if not any(i == j for j, _, _ in ok)]
    return sorted(out + [(i, 0, i) for i in rest])


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(25):
        base = rng.normal(size=32)
        for _ in range(rng.integers(1, 14)):
            rows.append((len(rows), [float(x) for x in base + rng.normal(size=32) * rng.choice([0.02, 0.1, 0.16])], int(rng.integers(2))))
    for k in (3, 3, 3, 7):  # repeated vectors
        rows.append((len(rows), rows[k][1], rows[k][2]))
    rows += [(len(rows), [0.0] * 32, 1), (len(rows) + 1, None, 1), (len(rows) + 2, rows[3][1], None),
             (len(rows) + 3, [float("nan")] + [1.0] * 31, 1), (len(rows) + 4, [None] + [1.0] * 31, 0),
             (len(rows) + 5, [], 0), (len(rows) + 6, rows[3][1][:16], rows[3][2]), (len(rows) + 7, [float("inf")] * 32, 0)]
    random.Random(1).shuffle(rows)
    d = crowded(spark.createDataFrame(rows, SCHEMA), "n_links", "component_id", "keys", "copies", "cid")
    # small blocks, so that buckets are cut
    out = op.near_duplicates(d, block=4).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def test_empty_and_single(spark):
    assert op.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    r = op.near_duplicates(spark.createDataFrame([(5, [1.0, 0.0], 1)], SCHEMA)).first()
    assert (r["n_links"], r["component_id"], r["kept"]) == (0, 5, True)


def test_hadamard_keeps_lengths_and_recall():
    rng = np.random.default_rng(1)
    x = op.unit_rows(rng.normal(size=(500, 64)))
    assert np.allclose(np.linalg.norm(op.hadamard(x), axis=1), 1)
    y = x + rng.normal(size=x.shape) * 0.0253  # cosine near 0.98
    y = op.unit_rows(y)
    near = (x * y).sum(1) >= 0.98
    a, b = op.hash_keys(x, 3), op.hash_keys(y, 3)
    hit = np.array([len(set(p) & set(q)) > 0 for p, q in zip(a.tolist(), b.tolist())])
    assert near.sum() > 100 and hit[near].mean() >= 0.98
