import random
import zlib

import pytest

from hearth.llm import op3_toxicity as op
from tests.llm.helpers import crowded, docs, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = random.Random(3)
    words = {w: 1.0 for w in ("dolt", "idiot", "abcabc", "grumbler", "worthlessly", "disgusting")}
    m = op.LexiconAutomaton(words, {"zorp": 1.0})
    tried = list(words) + ["zorping", "zorp", "zor"]
    for w in list(words) * 60:
        x = list(w)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(x) + 1)
            x[k:k + rng.randrange(2)] = rng.choice(["", "a", "q", w[0]])
        tried.append("".join(x))
    for t in tried:
        near = sorted((distance(t, w), w) for w in words if distance(t, w) <= m.edits(w))
        want = ("zorp", 0) if t.startswith("zorp") else (near[0][1], near[0][0]) if near else None
        assert m.match(t) == want, t


@pytest.fixture(scope="module")
def model():
    rng = random.Random(4)
    rows = []
    for i in range(300):
        words = prose(rng, 60).split()
        if i % 3 == 0:
            for w in rng.sample(["vexling", "grobian", "scoundr" + "ab cd ef gh"[rng.randrange(4) * 3:][:2]], 2):
                words.insert(rng.randrange(len(words)), w)
        rows.append((" ".join(words), int(i % 3 == 0)))
    return op.fit_rows(rows)


def test_learned_terms_and_scores(model):
    assert {"vexling", "grobian"} <= set(model.words) and any("scoundr".startswith(s) for s in model.stems)
    memo, weight = op._Memo(op.LexiconAutomaton(model.words, model.stems)), model.words | model.stems
    rng = random.Random(9)
    clean = prose(rng, 80)
    toxic = clean + " vexling " + prose(rng, 5) + " grobian"
    f = lambda t: float(model.score(__import__("numpy").array([op.text_features(t, memo, weight)]))[0])
    assert f(clean) < 0.3 and f("") < 0.3 and f(toxic) > 0.9
    quoted = clean + ' he said "vexling" ' + prose(rng, 20)
    aimed = clean + " you vexling " + prose(rng, 20)
    assert f(quoted) < f(aimed)


def test_held_out_rows_are_not_learned(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(240):
        bad = i % 2
        rows.append((i, prose(rng, 30) + (" zanyterm x zanyterm" if bad else "")))
        # the held-out third bears wrong labels; they must not matter
        wrong = zlib.crc32(str(i).encode()) % 3 == 1
        labels.append((i, 1, bad ^ wrong))
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    d = crowded(docs(spark, rows + [(None, None), (None, "")]), "score", "toxicity", "predicted")
    out = op.toxicity_scores(d, lab).collect()
    for r in out:
        if r["doc_id"] is None:
            assert r["held_out"] is False and 0 <= r["score"] < 0.7
            continue
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == r["doc_id"] % 2 == (r["score"] >= 0.7)
    kept = op.drop_toxic(d, lab)
    assert kept.columns == d.columns and kept.count() == 122


def test_no_labels_and_empty(spark):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    d = docs(spark, [(1, "a"), (1, "a")])
    assert {r["score"] < 1e-6 for r in op.toxicity_scores(d, lab).collect()} == {True}
    assert op.toxicity_scores(d.limit(0), lab).count() == 0


def test_accuracy_on_held_out(spark):
    from hearth.llm.common import read_table
    sf = "/root/testdata/sf0.1"
    out = op.toxicity_scores(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))
    got = out.where("held_out").join(read_table(spark, sf, "labels").where("toxic is not null"), "doc_id").select(
        "predicted", "toxic").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in got)
    assert hit >= 0.9 * sum(r["toxic"] for r in got) and hit >= 0.9 * sum(r["predicted"] for r in got)


def test_quotation_is_looked_up_once_per_text():
    """A mark before and one after the hit within the window; long texts of hits take time in proportion."""
    import time

    words = {"vilest": 4.0}
    weight = dict(words)
    memo = op._Memo(op.LexiconAutomaton(words, {}))
    for text, quoted in (('he "vilest" x', True), ('"a vilest', False), ('vilest" b', False), ('" ' + "w " * 7 + 'vilest "', False),
                         ('a " ' + "w " * 5 + 'vilest"', True), ("x «vilest» y", True), ("vilest", False), ('""vilest', False)):
        f = op.text_features(text, memo, weight)
        assert (f[2] > 0) == quoted and (f[0] > 0) == (not quoted), text

    def seconds(n):
        t = time.perf_counter()
        op.text_features("vilest one two " * n, memo, weight)
        op.text_features("vilest one two " * n + '"', memo, weight)
        return time.perf_counter() - t

    seconds(100)
    assert seconds(16_000) < 2.0


def test_driver_learns_without_the_texts(spark, monkeypatch):
    """The model from a table is that of its rows, and no text of the sample reaches the driver."""
    from pyspark.sql import DataFrame
    rng = random.Random(12)
    rows = [(9, "grobian " + prose(rng, 10))] * 2 + [(7, None)]
    for i in range(300):
        words = prose(rng, 40).split()
        for w in ["grobian", "scoundr" + rng.choice(["el", "y", "ing", "ish"])] if i % 3 == 0 else []:
            words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
    mine = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1]
    lab = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    d = docs(spark, rows)
    got, seen = DataFrame.collect, []
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(self.columns) or got(self))
    model = op.fit_toxicity(d, lab)
    monkeypatch.undo()
    assert not any("text" in c for c in seen)
    plain = op.fit_rows(sorted((t or "", int(i % 3 == 0)) for i, t in rows if i in set(mine)))
    assert model.words == plain.words and model.stems == plain.stems and "grobian" in model.words
    assert model.weights == pytest.approx(plain.weights, abs=1e-5) and model.bias == pytest.approx(plain.bias, abs=1e-5)
