import random

import pytest

from hearth.llm import op8_jaccard as op
from tests.llm.helpers import crowded, docs, prose


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and None not in (sets[a][0], sets[b][0]):
                shared = len(x & y)
                if 100 * shared >= 75 * (len(x) + len(y) - shared):
                    parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return sorted(((i, len(s), None if i is None else low[find(k)]) for k, (i, s) in enumerate(sets)), key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def corpus(seed):
    """Groups of edited copies of all sizes, short texts, shared passages."""
    rng = random.Random(seed)
    passage = prose(rng, 30, 5000)
    rows = []
    for g in range(40):
        base = prose(rng, rng.choice([3, 5, 7, 8, 9, 11, 14, 18, 24, 40, 80, 150]), 3000).split()
        for _ in range(rng.randrange(1, 9)):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 25 + 1)):
                k = rng.randrange(len(w))
                w[k:k + rng.randrange(2)] = [f"e{rng.randrange(9999)}"] * rng.randrange(2)
            if rng.random() < 0.3:
                w = w + passage.split()
            if w and rng.random() < 0.2:
                w[0] = w[0].upper()
            rows.append((len(rows), "  ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    rows = corpus(seed)
    if seed == 2:  # heavy and salted lists, all of them long, tiny blocks
        monkeypatch.setattr(op, "HEAVY_LEAST", 2)
        monkeypatch.setattr(op, "LIST_ROWS", 2)
        monkeypatch.setattr(op, "LONG_LIST", 3)
        monkeypatch.setattr(op, "BLOCK", 3)
    rows += [(None, rows[0][1]), (900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "a b c d"),
             (3, rows[3][1]), (3, "quite another text than the row with the same id has")]
    random.Random(seed).shuffle(rows)
    d = crowded(docs(spark, rows), "sid", "n", "key", "bits", "kind", "component_id")
    assert result(op.jaccard_components(d)) == brute(rows)


def test_large_group_of_near_copies(spark):
    rng = random.Random(7)
    base = prose(rng, 150, 5000).split()
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rng.randrange(3, 7)):
            w[rng.randrange(len(w))] = f"e{i}x{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    assert result(op.jaccard_components(docs(spark, rows))) == brute(rows)


def test_bitmaps_never_rule_out_a_link():
    rng = random.Random(4)
    for _ in range(300):
        w = prose(rng, rng.randrange(5, 120), 60).split()
        v = list(w)
        for _ in range(rng.randrange(6)):
            v[rng.randrange(len(v))] = "z"
        x, y = op.shingle_set(" ".join(w).encode()), op.shingle_set(" ".join(v + ["q"] * rng.randrange(40)).encode())
        assert op.most_shared(op.set_bits(x), op.set_bits(y), len(x), len(y)) >= len(set(x.tolist()) & set(y.tolist()))


def test_word_hashes_tell_words_apart():
    """Equal words (A-Z folded) hash alike wherever they stand, different ones do not; white space is ASCII's."""
    rng = random.Random(6)
    alphabet = "abcAZz09\xc3\u00e9\u6f22.\x1c\u00a0\x00"
    words = ["".join(rng.choice(alphabet) for _ in range(rng.choice([1, 2, 3, 8, 30]))) for _ in range(3000)]
    words += ["x" * 4095, "x" * 4096, "x" * 4097, "y" + "x" * 20_000, "x" * 20_000 + "y", "X" * 4097]
    text = "".join(w + rng.choice([" ", "\t\n", "\x0b", "\x0c\r  "]) for w in words)
    for lead in ("", " \n", "\t"):
        got = op.word_hashes((lead + text).encode()).tolist()
        plain = (lead + text).encode().lower().split()
        assert len(got) == len(plain)
        assert len(set(got)) == len(set(plain)) == len(set(zip(got, plain)))
    assert not len(op.word_hashes(b" \n\t ")) and not len(op.shingle_set(None)) and not len(op.shingle_set(b" "))
    assert op.shingle_set(b"a b c").tolist() == op.shingle_set(b" A  b\tc ").tolist() != op.shingle_set(b"a c b").tolist()


def test_prefix_and_boundary():
    for n in range(1, 200):
        least = -(-75 * n // 100)
        assert op.prefix_length(n, 1) == n - least + 1 and op.prefix_length(n, 2) == min(n, n - least + 2)
    assert op.size_boundary(0.0) < op.size_boundary(5.0) <= op.SMALL_MOST


def test_drop_long_and_empty(spark):
    big = prose(random.Random(5), 30_000, 9000)
    d = docs(spark, [(1, big), (2, big + " tail"), (3, "short one here"), (4, None), (5, None)])
    kept = op.drop_near_duplicates(d)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5] and kept.columns == d.columns
    assert op.jaccard_components(d.limit(0)).count() == 0


def test_drop_decides_by_id_and_set(spark):
    rng = random.Random(8)
    a, b, c, e = (prose(rng, 60, 3000) for _ in range(4))
    rows = [(1, a), (3, a + " tail"), (3, b), (4, b + " tail"), (4, b + " tail"), (5, c), (5, c + " more"), (5, c), (6, c),
            (7, e), (7, e), (None, a), (None, "lone null id"), (3, ""), (3, None)]
    left = [(r["doc_id"], r["text"]) for r in op.drop_near_duplicates(crowded(docs(spark, rows), "kept", "key", "rows")).collect()]
    five = [t for i, t in left if i == 5]
    assert len(five) == 1 and five[0] in (c, c + " more")
    assert sorted((x for x in left if x[0] != 5), key=repr) == sorted(
        [(1, a), (3, b), (7, e), (None, a), (None, "lone null id"), (3, ""), (3, None)], key=repr)


def test_bitmaps_are_short_and_tell_sets_apart():
    """At most 8 bits for each shingle are moved, and they rule out pairs that share little."""
    rng = random.Random(9)
    for n in (30, 100, 400):
        x, y = (op.shingle_set(prose(rng, n, 10 ** 6).encode()) for _ in range(2))
        p, q = op.set_bits(x), op.set_bits(y)
        assert len(p) <= max(8, len(x))
        most = op.most_shared(p, q, len(x), len(y))
        assert 100 * most < 75 * (len(x) + len(y) - most)


def test_few_sets_move_only_their_rows(spark):
    table = spark.range(100).withColumnRenamed("id", "sid")
    ids = spark.createDataFrame([(3,), (5,), (200,)], "sid long")
    assert sorted(r["sid"] for r in op.narrowed(table, ids).collect()) == [3, 5]
    assert op.narrowed(table, spark.range(op.FEW_SETS + 1).withColumnRenamed("id", "sid")) is table


@pytest.mark.parametrize("rows", [1, 10_000])
def test_repeats_are_counted_over_runs_of_batches(spark, rows, monkeypatch):
    """Arrow batches of a few rows give the same counts; a run of one row has no repeats."""
    monkeypatch.setattr(op, "COUNTED", rows)
    text = "a b c d e f g h i j k l m n o"
    d = docs(spark, [(i, f"{text} p{i}") for i in range(30)]).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        out = op.set_profiles(d).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(r["kind"] == 0 for r in out) == 30
    assert sum(r["n"] for r in out if r["kind"] == 2) == sum(op.prefix_length(12, 1) for _ in range(30))
    assert (sum(r["kind"] == 2 for r in out) == 1) == (rows > 30)
    assert max([r["n"] for r in out if r["kind"] == 1], default=0) > (20 if rows > 30 else -1)


def test_shuffle_files_of_a_pass_go_before_the_next_step(spark, monkeypatch):
    """Another plan ends and the collector runs between a pass over the texts and what follows."""
    rng, steps = random.Random(21), []
    write, let_go = op.written, op.release
    monkeypatch.setattr(op, "written", lambda df, name, few=False: steps.append(name) or write(df, name, few))
    monkeypatch.setattr(op, "release", lambda s: steps.append("release") or let_go(s))
    d = docs(spark, [(i, prose(rng, 30)) for i in range(20)])
    assert op.jaccard_components(d).count() == 20
    at = [i for i, x in enumerate(steps) if x == "lists"][:op.PASSES]
    assert len(at) == op.PASSES
    for i in at:
        assert steps[i + 1] not in ("lists", "release") and steps[i + 2] == "release", steps


def test_sets_of_a_slab_are_those_of_each_text(monkeypatch):
    """Texts hashed together keep their own sets, in whatever slabs; one of a slab's places is past the table of powers."""
    rng = random.Random(11)
    texts = [prose(rng, rng.choice([0, 1, 2, 4, 5, 6, 60, 900]), 50).encode() for _ in range(200)]
    texts += [None, b"", b" \n", b"a" * 70_000 + b" b c d e f", b" " * 70_000 + b"A b C d e f", b"\xff\x00 \x1c x y z"]
    rng.shuffle(texts)
    for slab in (1, 500, 1 << 20):
        monkeypatch.setattr(op, "SLAB", slab)
        got = [s.tolist() for s in op.shingle_sets(texts)]
        assert got == [op.shingle_set(t).tolist() for t in texts]
        assert [len(s) for s in got] == [len(shingles((t or b"").decode("latin-1"))) if t and b"\xff" not in t else n
                                         for t, n in zip(texts, map(len, got), strict=True)]


def test_lists_are_sorted_by_one_column(spark):
    """Spark's radix sort takes one column; the lists come out whole, without repeats, over any batches."""
    rng = random.Random(12)
    keys = [rng.randrange(-1 << 62, 1 << 62) for _ in range(60)]
    rows = [(k, rng.randrange(1, 500), s) for k in keys for s in (0, 1, 2) for _ in range(rng.choice([1, 1, 2, 30]))]
    rows += [(k, i, s) for k, i, s in rows if rng.random() < 0.3] + [(keys[0], i % 40, 0) for i in range(900)]
    named = [(int(op._salted(op.np.array([k]), op.np.array([s], op.np.int32))[0]), s, i, i % 7 + 3) for k, i, s in rows]
    wanted = []
    for k, s in {(k, s) for k, _, s in rows}:
        m = sorted({i for q, i, t in rows if (q, t) == (k, s)})
        wanted += [(k, i, i % 7 + 3, m[0], m[0] % 7 + 3) for i in m if len(m) > 1 or s]
    entries = spark.createDataFrame(named, "list long, salt int, sid long, n int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        members = op.list_members(entries)
        plan = members._jdf.queryExecution().executedPlan().toString()
        assert [x.split("]")[0].count(",") for x in plan.split("Sort [")[1:]] == [0]
        assert sorted(tuple(r) for r in members.collect()) == sorted(wanted)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_blocks_compared_by_parts_lose_no_pair():
    """What a part of the bitmaps rules out, the whole ones rule out too; all other pairs stay."""
    rng, rows = random.Random(13), []
    for i in range(120):
        w = prose(random.Random(i % 9), 200, 10 ** 6).split()[:rng.choice([12, 40, 60, 190, 200])]
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"e{i}"
        s = op.shingle_set(" ".join(w).encode())
        rows.append([i + 1, len(s), i % 5, op.set_bits(s), [3, 8]])
    wanted = {(x[0], y[0]) for k, x in enumerate(rows) for y in rows[k + 1:] if x[2] != y[2]
              and 100 * min(x[1], y[1]) >= 75 * max(x[1], y[1])
              and 100 * (m := op.most_shared(x[3], y[3], x[1], y[1])) >= 75 * (x[1] + y[1] - m)}
    got = op.block_pairs((rows, []), True, 3, None, 75, 100)
    assert {tuple(sorted(p)) for p in got} == wanted and len(got) == len(wanted) > 50
    assert not op.block_pairs((rows, []), True, 8, None, 75, 100)
    folded = op._bits_apart(op._folded(op.np.arange(64, dtype=op.np.uint64).reshape(4, 16), 4), op.np.zeros((3, 4), op.np.uint64))
    assert folded.shape == (4, 3) and folded[0, 0] == sum((a | a + 4 | a + 8 | a + 12).bit_count() for a in range(4))
