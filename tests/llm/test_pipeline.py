import sys
from collections import Counter

import corpus_pipeline as cp
from hearth.llm import op3_toxicity, op7_pieces, op8_jaccard, op10_mix
from hearth.llm.common import components, read_table, written
from tests.llm.test_exact import LOW
from tests.llm.test_jaccard import brute as near

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Every stage on the rows that the one before kept, against plain Python."""
    docs = read_table(spark, SF, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = op3_toxicity.fit_toxicity(docs, read_table(spark, SF, "labels"))
    memo = op3_toxicity._Memo(op3_toxicity.LexiconAutomaton(model.words, model.stems))
    import numpy as np
    bad = {i for i, r in rows.items() if model.score(np.array([op3_toxicity.text_features(
        r["text"] or "", memo, model.words | model.stems)]))[0] >= op3_toxicity.THRESHOLD}
    want = set(rows) - bad
    out = written(cp.toxicity(spark, docs, SF), "t")
    assert {r["doc_id"] for r in out.collect()} == want and out.columns == docs.columns
    last = {}
    for i in sorted(want):
        last[(rows[i]["text"] or "").translate(LOW)] = i
    want = set(last.values())
    out = written(cp.exact_dedup(spark, out, SF), "t")
    assert {r["doc_id"] for r in out.collect()} == want and out.columns == docs.columns
    want = {i for i, _, c in near([(i, rows[i]["text"]) for i in want]) if i == c}
    out = written(cp.near_dedup(spark, out, SF), "t")
    assert {r["doc_id"] for r in out.collect()} == want and out.columns == docs.columns
    taken = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) if r["size"] else 0 for r in op10_mix.mix_sources(out).collect()}
    out = written(cp.mix(spark, out, SF), "t")
    assert Counter(r["doc_id"] for r in out.collect()) == {i: n for i, n in taken.items() if n} and out.columns == docs.columns
    enc = cp.encode(spark, out, SF)
    back = Counter((r["doc_id"], r["text"]) for r in op7_pieces.decode(enc.where("sample = 1")).collect())
    assert back == {(i, rows[i]["text"]): n for i, n in taken.items() if n}


def test_run_and_stage_list(spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix", "encode"]
    assert cp.run(spark, SF).count() > 0


def test_stages_on_an_empty_table(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_components(spark):
    rows = [(1, 2), (2, 3), (5, 4), (4, 5), (7, 7), (None, 1), (9, None)] + [(100, 100 + i) for i in range(1, 50)] + \
           [(200 + i, 201 + i) for i in range(60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4} | {100 + i: 100 for i in range(50)} | {200 + i: 200 for i in range(61)}
    assert got == want


def test_registered_queries():
    import __spark_entry__ as entry
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_no_other_module_imports_the_subpackage():
    import pathlib
    import re
    root = pathlib.Path(cp.__file__).parent
    for p in [*(root / "hearth").rglob("*.py"), root / "bench.py"]:
        if "llm" not in p.parts:
            assert not re.search(r"^\s*(?:from|import)\s+\S*llm", p.read_text(), re.M), p
    assert op8_jaccard.__name__ in sys.modules
