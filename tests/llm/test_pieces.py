import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from hearth.llm import op7_pieces as op
from tests.llm.helpers import crowded, docs, prose

TEXTS = ["", " ", "the cat", "a  b\nc ▁ x", "é漢𝄞 q\t", "hello world  ", "▁", "\x00x", "wordswithoutanyspace" * 30]


@pytest.fixture(scope="module")
def pieces():
    return op.load_pieces()


def every_segmentation(text, pieces):
    """All segmentations of a text with their weights, by brute force over the vocabulary."""
    known = {}
    for n, i in enumerate(pieces.piece):
        if i >= 0:
            known[pieces.texts[i]] = (int(i), float(pieces.weight[n]))
    t = text.replace(" ", "▁")
    out = []
    for cuts in itertools.product((0, 1), repeat=len(t) - 1):
        parts, a = [], 0
        for k, c in enumerate((*cuts, 1), 1):
            if c:
                parts.append(t[a:k])
                a = k
        if all(p in known for p in parts):
            out.append((tuple(known[p][0] for p in parts), math.exp(sum(known[p][1] for p in parts))))
    total = sum(w for _, w in out)
    return {s: w / total for s, w in out}


def test_round_trip_and_distinct_samples(pieces):
    texts = TEXTS + [prose(random.Random(i), 50) for i in range(5)]
    for t, samples in zip(texts, op.sample_group(texts, op.row_keys(list(range(len(texts))), 1), pieces, 4, 1.0)):
        assert samples and len({tuple(s[0]) for s in samples}) == len(samples)
        assert all(op.decode_ids(s[0], pieces) == t for s in samples)
        values = [s[2] for s in samples]
        assert values == sorted(values, reverse=True)
    assert [op.decode_ids(x, pieces) for x in op.best_group(texts, pieces, 1.0)] == texts


def test_all_segmentations_are_drawn_once(pieces):
    want = every_segmentation("hat a", pieces)
    got = op.sample_group(["hat a"], op.row_keys([3], 1), pieces, 100, 1.0)[0]
    assert {tuple(s[0].tolist()) for s in got} == set(want)
    for ids, lp, _, inclusion in got:
        assert math.isclose(math.exp(lp), want[tuple(ids.tolist())], rel_tol=1e-9)
        assert inclusion == 0.0  # nothing is left out, so each is sure
    best = max(want, key=want.get)
    assert tuple(op.best_group(["hat a"], pieces, 1.0)[0].tolist()) == best


def test_frequencies_match_probabilities(pieces):
    text, n = "then he", 6000
    want = every_segmentation(text, pieces)
    res = op.sample_group([text] * n, op.row_keys(list(range(n)), 5), pieces, 2, 0.5)
    flat = {s: w ** 0.5 for s, w in want.items()}
    total = sum(flat.values())
    flat = {s: w / total for s, w in flat.items()}
    first = Counter(tuple(r[0][0].tolist()) for r in res)
    both = Counter(tuple(s[0].tolist()) for r in res for s in r)
    for s, p in flat.items():
        assert abs(first[s] / n - p) < 0.03
        second = p + sum(q * p / (1 - q) for z, q in flat.items() if z != s)
        assert abs(both[s] / n - second) < 0.03
    # inclusion scores make the weighted samples unbiased
    assert abs(np.mean([sum(math.exp(s[1] - s[3]) for s in r) for r in res]) - 1) < 0.03


def test_rows_do_not_depend_on_the_group(pieces):
    texts = TEXTS + [prose(random.Random(9), 3000)]
    keys = op.row_keys(list(range(len(texts))), 42)
    whole = op.sample_group(texts, keys, pieces, 3, 1.0)
    for i in range(len(texts)):
        alone = op.sample_group(texts[i:i + 1], keys[i:i + 1], pieces, 3, 1.0)[0]
        assert [s[0].tolist() for s in alone] == [s[0].tolist() for s in whole[i]]


def test_table_rows(spark):
    d = crowded(docs(spark, [(1, "the cat sat"), (1, "the cat sat"), (None, None), (2, ""), (3, prose(random.Random(1), 20_000))]),
                "ids", "sample")
    out = op.sample_encodings(d)
    rows = out.collect()
    assert Counter(r["doc_id"] for r in rows) == {1: 4, None: 1, 2: 1, 3: 2}
    assert all(r["restored"] for r in rows)
    assert len({tuple(r["ids"]) for r in rows if r["doc_id"] == 1}) == 2  # the same row key, the same samples
    back = {(r["doc_id"], r["text"]) for r in op.decode(out).collect()}
    want = {(r["doc_id"], r["text"] or "") for r in d.collect()}
    assert back == want
    assert {(r["doc_id"], r["text"]) for r in op.decode(op.encode_best(d)).collect()} == want
    assert op.sample_encodings(d.limit(0)).count() == 0


def test_restored_tells_a_wrong_sample(spark):
    """The flag compares what the ids stand for with the text."""
    known = op.piece_bytes(op.load_pieces())
    ids = op.best_group(["the cat"], op.load_pieces(), 1.0)[0]
    assert op.join_pieces(ids, known) == b"the cat" and op.join_pieces(ids[:-1], known) != b"the cat"
    one = op.sample_encodings(docs(spark, [(i, t) for i, t in enumerate(TEXTS)])).collect()
    assert {r["doc_id"] for r in one} == set(range(len(TEXTS))) and all(r["restored"] for r in one)


def test_a_batch_is_held_a_group_at_a_time():
    """Memory follows the group, not the batch: numpy's arrays and the texts of 2 million characters."""
    import tracemalloc

    import pyarrow as pa
    rng = random.Random(12)
    texts = [" ".join(f"{rng.randrange(16 ** 5):x}" for _ in range(1500)) for _ in range(220)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    pieces = op.load_pieces()
    tracemalloc.start()
    try:
        seen = []
        for names, part in op._groups(batch):
            assert sum(map(len, part[:-1])) < op.GROUP
            seen += zip(names, part)
            op.sample_group(part, op.row_keys(names, 1), pieces, 2, 1.0)
        assert tracemalloc.get_traced_memory()[1] < 200e6
    finally:
        tracemalloc.stop()
    assert seen == [(i, t or "") for i, t in enumerate(texts)]


def test_sequences_laid_end_to_end_decode_as_each_alone():
    import numpy as np
    import pyarrow as pa
    pieces = op.load_pieces()
    known = op.piece_bytes(pieces)
    texts = ["", "one two  three", "x▁y \U0001F600 ", "é" * 30, ""]
    ids = op.best_group(texts, pieces, 1.0)
    for some in (ids, ids[:1], []):
        flat = np.concatenate(some) if some else np.zeros(0, np.int32)
        got = list(op.decoded(flat, np.array([len(x) for x in some], np.int32), pa.array(known, pa.large_binary())))
        assert got == [op.join_pieces(x.tolist(), known) for x in some] == [t.encode() for t in texts[:len(some)]]
