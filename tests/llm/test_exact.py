import hashlib
import random
from collections import defaultdict

from hearth.llm import op6_exact as op
from tests.llm.helpers import crowded, docs

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOW)].append(r[0])
    out = []
    for r in rows:
        t = (r[1] or "").translate(LOW)
        ids = [i for i in groups[t] if i is not None]
        keep = max(ids) if ids else None
        out.append((r[0], keep, len(groups[t]), r[0] == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()), key=repr)


def test_against_brute_force_with_small_blocks(spark):
    rng = random.Random(2)
    texts = ["", None, "a", "A", "ä", "Ä", "aÄb", "AÄB"]
    texts += ["".join(rng.choice("abAB") for _ in range(rng.randrange(1, 7))) for _ in range(120)]
    texts += ["ab" * 40, "AB" * 40, "ab" * 39 + "ac", "ab" * 40 + "a", "b" * 17, "b" * 16, "b" * 15]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "A"), (3, "zz"), (None, "a"), (None, "only null"), (None, None)]
    rng.shuffle(rows)
    d = crowded(docs(spark, rows), "name", "level", "kept", "block", "h", "pos")
    for size in (1, 2, 3, 2048):
        assert result(op.exact_duplicates(d, size)) == brute(rows), size


def test_hash_clash_is_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F
    # every block gets one of three hashes: names must still come from the contents
    monkeypatch.setattr(op.F, "xxhash64", lambda c: (F.length(c) % 3).cast("long"))
    rows = [(i, t) for i, t in enumerate(["ab", "ba", "ab", "abc", "cba", "abcabc", "cbaabc", "abcabc", "", "x" * 9, "y" * 9])]
    for size in (2, 3, 100):
        assert result(op.exact_duplicates(docs(spark, rows), size)) == brute(rows)


def test_long_texts_empty_table_and_drop(spark):
    big = "long text " * 60_000
    rows = [(1, big), (2, big.upper()), (3, big + "x"), (4, "s"), (5, "S")]
    assert result(op.exact_duplicates(docs(spark, rows))) == brute(rows)
    d = docs(spark, rows)
    assert sorted(r["doc_id"] for r in op.drop_duplicates(d).collect()) == [2, 3, 5]
    assert op.drop_duplicates(d).columns == d.columns
    assert op.exact_duplicates(d.limit(0)).count() == 0


def test_drop_decides_by_id_and_text(spark):
    rows = [(3, "A"), (3, "zz"), (5, "a"), (None, "a"), (None, "only null"), (None, "Only null"), (None, "zz"), (7, "same"),
            (7, "same"), (7, "Same"), (8, "x"), (8, "y"), (9, "y"), (2, None), (2, "")]
    d = docs(spark, rows)
    left = sorted(((r["doc_id"], (r["text"] or "").translate(LOW)) for r in op.drop_duplicates(crowded(d, "kept", "key", "rows")).collect()), key=repr)
    assert left == sorted([(3, "zz"), (5, "a"), (None, "only null"), (7, "same"), (8, "x"), (9, "y"), (2, "")], key=repr)
    texts = [(r[1] or "").translate(LOW) for r in rows]
    assert sorted(t for _, t in left) == sorted(set(texts))  # one row of every text
