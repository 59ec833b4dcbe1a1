import random
from collections import defaultdict

from hearth.llm import op10_mix as op
from tests.llm.helpers import crowded, docs, prose


def fill(sizes):
    """Targets by reshare rounds: cap what is above, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    rest, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > 2 * sizes[s]}
        if not over:
            target |= {s: unit * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        open_ -= over
    return target


def corpus():
    rng = random.Random(6)
    rows = []
    for s, n in (("a", 300), ("b", 40), ("c", 25), ("Z", 60), (None, 30), ("é", 9), ("tiny", 1)):
        rows += [(len(rows) + i, prose(rng, rng.randrange(0, 160)), s) for i in range(n)]
    return rows + [(None, "x y z", "a"), (5000, None, "b"), (5001, " \n", "b"), (7, "seven seven", "c"), (7, "seven seven", "c")]


def test_targets_and_words(spark):
    rows = corpus()
    d = crowded(docs(spark, rows), "size", "target", "taken", "_s", "_mix", "slot", "weight")
    out = op.mix_sources(d, block=16).collect()
    size = defaultdict(int)
    for r in rows:
        size[r[2]] += len((r[1] or "").split())
    want = fill(size)
    taken = defaultdict(int)
    assert len(out) == len(rows)
    for r in out:
        assert r["source_size"] == size[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in size:
        assert abs(taken[s] - want[s]) <= 3 * 16, (s, taken[s], want[s])
    again = op.mix_sources(d.repartition(7), block=16).collect()
    key = lambda r: repr((r["doc_id"], r["size"], r["source"], r["taken"]))
    assert sorted(map(key, again)) == sorted(map(key, out))


def test_schedule_is_even_at_every_point(spark):
    rows = [(1, 3000.0, 9000), (2, 1000.0, 9000), (3, 600.0, 9000)]
    t = spark.createDataFrame(rows, "_s int, target double, source_size long")
    slots = sorted((r["slot"], r["_s"], r["rank"]) for r in op.slot_schedule(t, 2).collect())
    assert [s[0] for s in slots] == list(range(2300))
    seen = defaultdict(int)
    for n, (_, s, rank) in enumerate(slots, 1):
        assert rank == seen[s]
        seen[s] += 1
        for x, target, _ in rows:
            assert abs(seen[x] - n * target / 4600) <= 4


def test_documents_are_taken_whole_number_of_times(spark):
    d = docs(spark, corpus())
    mixed = op.mixed_documents(d, block=16)
    assert mixed.columns == d.columns
    got = defaultdict(int)
    for r in mixed.collect():
        got[(r["doc_id"], r["source"])] += 1
    for r in op.mix_sources(d, block=16).collect():
        if r["doc_id"] != 7 and r["size"]:
            assert got[(r["doc_id"], r["source"])] == int(r["taken"] / r["size"] + 0.5)
    assert (5000, "b") not in got


def test_empty(spark):
    d = docs(spark, [(1, None), (2, "")])
    assert [(r["size"], r["target"], r["taken"]) for r in op.mix_sources(d).collect()] == [(0, 0.0, 0)] * 2
    assert op.mix_sources(d.limit(0)).count() == 0 and op.mixed_documents(d.limit(0)).count() == 0


def test_no_python_in_plan(spark):
    plan = op.mix_sources(docs(spark, [(1, "a b", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
