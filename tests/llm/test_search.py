import math
import random
import re
from collections import Counter

import pytest

from hearth.llm import op13_search as op
from tests.llm.helpers import crowded, docs, found

COLS = ("item_id", "rank", "doc_id", "score")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(text or "")]


def brute(rows, items, top=10):
    held = [(i, terms(t)) for i, t in rows]
    held = [(i, w) for i, w in held if w]
    n, total = len(held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    asked = {}
    for i, t in set(items):
        if i is not None:
            asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, want in asked.items():
        scores = []
        for doc, w in held:
            tf, s = Counter(w), 0
            m = 100 - 75 + (75 * len(w) * n) // total
            for t, times in want.items():
                if tf[t]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    s += times * weight * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if s > 0 and doc is not None:
                scores.append((-s, doc))
        out += [(item, k + 1, d, -s) for k, (s, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def texts(rng, words, least=1, most=60):
    return " ".join(rng.choice(words) for _ in range(rng.randint(least, most)))


@pytest.mark.parametrize("shard, bundle, slice_terms", [(2048, 256, 200_000), (16, 3, 200_000), (8, 256, 40)])
def test_against_brute_force(spark, shard, bundle, slice_terms):
    rng = random.Random(shard)
    # word frequencies from one document to nearly all
    words = [f"w{k}" for k in range(300) for _ in range(1 + 600 // (k + 1))]
    rows = [(i, texts(rng, words)) for i in range(300)]
    rows += [(1000 + k, "the same text of many w1 w2 w3 w200") for k in range(40)]  # ties
    items = [(k, texts(rng, words, 1, 25)) for k in range(12)] + [(50, rows[7][1]), (51, "w1"), (52, "w1 w1 w1 w299"), (53, "of the many w200")]
    got = found(op.ranked_search(docs(spark, rows).repartition(3), table(spark, items), slice_terms=slice_terms,
                                 bundle=bundle, shard=shard), *COLS)
    assert got == brute(rows, items)


def test_edge_rows(spark):
    long = " ".join(f"x{k % 999}" for k in range(150_000))
    rows = [(1, "Ab c-d É"), (1, "ab"), (2, None), (3, ""), (4, "-- !"), (None, "ab ab ab rare"), (5, "É é ÀB"), (6, "ab"), (6, "ab"),
            (7, long), (8, "a\0b\tc_d 漢字 🙂"), (9, "AB,ab;aB")]
    items = [(0, "AB"), (0, "AB"), (0, "É"), (1, None), (2, ""), (3, "zzz unknown"), (None, "ab"), (4, "x5 x5 x7"), (5, "rare"), (6, "漢字 b 🙂"),
             (7, "é"), (8, long), (-1, "c d")]
    got = op.ranked_search(crowded(docs(spark, rows), "item_id", "score", "rank", "n", "shard"), crowded(table(spark, items), "doc_id", "term"))
    assert found(got, *COLS) == brute(rows, items)
    assert got.where("doc_id is null").count() == 0


def test_empty_tables(spark):
    none, some = docs(spark, []), docs(spark, [(1, "a b")])
    assert op.ranked_search(none, table(spark, [(1, "a")])).count() == 0
    assert op.ranked_search(some, table(spark, [])).count() == 0
    assert op.ranked_search(docs(spark, [(1, None), (2, "--")]), table(spark, [(1, "a")])).count() == 0
    assert op.ranked_search(some, table(spark, [(1, "c")])).count() == 0
    assert op.ranked_search(none, table(spark, [])).columns == list(COLS)


def test_a_word_in_every_document(spark):
    """A term of all documents weighs little but counts; with equal scores the smaller ids win."""
    rows = [(i, "all " + ("one" if i % 7 == 0 else "")) for i in range(100)]
    items = [(1, "all"), (2, "all one")]
    assert found(op.ranked_search(docs(spark, rows), table(spark, items)), *COLS) == brute(rows, items)


def test_stages_drop_documents_that_cannot_win(spark):
    """Accumulators of common words only are not carried once ten documents are out of their reach."""
    rng = random.Random(9)
    rows = [(i, "common words " + texts(rng, [f"w{k}" for k in range(50)], 5, 10) + (" very rare terms" if i < 12 else "")) for i in range(400)]
    items = [(1, "common words very rare terms w1 w2")]
    assert found(op.ranked_search(docs(spark, rows), table(spark, items)), *COLS) == brute(rows, items)
    pairs = [(0, k, 1) for k in range(4)]
    corpus = op.Corpus(1000, 10_000)
    plan = op.Plan(pairs, [1], {0: (10, 500_000), 1: (100, 500_000), 2: (300, 500_000), 3: (990, 500_000)}, corpus, 4)
    assert plan.stage.tolist() == sorted(plan.stage.tolist()) and plan.stage[0] == 0 and plan.stage[3] == 3
    assert plan.rest[-1, 0] == 0 and (plan.rest[:-1, 0] >= plan.rest[1:, 0]).all()
