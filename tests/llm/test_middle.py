import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearth.llm import op12_middle as op
from tests.llm.helpers import crowded, docs, prose

COLS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back")


def brute(doc_id, text):
    """The transformation by plain code points."""
    t = text or ""
    h = hashlib.sha256(("1:" + ("null" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(t)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, t, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, n, form, a, b - a, out, t


def test_against_plain_code_points(spark):
    rng = random.Random(4)
    shared = prose(rng, 3000)
    alphabet = "ab <>PSM\n\0é漢🙂"
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.choice([1, 2, 7, 40, 300])))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "x"), (203, "<P>"), (204, "a<M"), (205, "a<M>"), (None, "no id"), (None, None), (7, rows[7][1]),
             (7, "another text of the same id"), (-3, "negative"), (2 ** 62, "big")]
    rows += [(300 + i, prose(rng, 50) + shared + prose(rng, 30)) for i in range(30)]
    rows += [(400, "é" * 700_000 + "🙂" * 300_000), (401, "<" * 100_000 + "P>"), (402, "x" * 1_500_000), (403, " ".join([shared] * 60))]
    out = op.fill_in_middle(crowded(docs(spark, rows), "n", "form", "output", "prefix_chars", "middle_chars")).withColumn(
        "back", op.restored(F.col("output"), F.col("form")))
    got = [tuple(r[c] for c in COLS) for r in out.collect()]
    assert sorted(got, key=repr) == sorted((brute(i, t) for i, t in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    out = op.middle_digest(docs(spark, []))
    assert out.count() == 0 and out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab<>PSMé漢🙂\n", max_size=200), st.integers(0, 50), st.integers(1, 40))
def test_summaries_and_cuts(text, point, repeat):
    text = text * repeat
    data, memo = text.encode(), op.ChunkMemo()
    ends, upto, marked = op.text_summary(data, memo)
    assert marked == any(m in text for m in ("<P>", "<S>", "<M>"))
    assert (int(upto[-1]) if len(upto) else 0) == len(text)
    point = min(point * repeat, len(text))
    assert op.byte_of(data, point, ends, upto) == len(text[:point].encode())


def test_marker_straddles_chunk_ends(monkeypatch):
    """With a chunk end after every byte, or every second or third, markers are still seen."""
    import numpy as np
    for step in (1, 2, 3):
        monkeypatch.setattr(op, "chunk_ends", lambda t, s=step: np.unique(np.append(np.arange(s, len(t), s), len(t))) if t else np.zeros(0, int))
        for text, want in ((b"ab<P>cd", True), (b"ab<P", False), (b"<M>", True), (b"<<S>", True), (b"< P>", False), (b"a<S", False)):
            ends, upto, marked = op.text_summary(text, op.ChunkMemo())
            assert marked == want and upto[-1] == len(text)
            assert [op.byte_of(text, k, ends, upto) for k in range(len(text) + 1)] == list(range(len(text) + 1))


def test_chunks_follow_content_and_are_remembered():
    rng = random.Random(1)
    shared = prose(rng, 20_000).encode()
    ends = op.chunk_ends(shared)
    sizes = [b - a for a, b in zip([0, *ends.tolist()], ends.tolist())]
    assert 500 < sum(sizes) / len(sizes) < 2000 and max(sizes) <= op.LONGEST
    moved = op.chunk_ends(b"some words before " + shared) - 18
    assert len(set(moved.tolist()) & set(ends.tolist())) >= len(ends) - 2
    memo = op.ChunkMemo()
    op.text_summary(shared, memo)
    first = memo.computed
    op.text_summary(b"some words before " + shared, memo)
    assert memo.computed - first <= 2  # only the chunks at the edge are new
    small = op.ChunkMemo(limit=4096)
    assert op.text_summary(shared, small)[1][-1] == len(shared) and small.held <= 4096 + op.LONGEST
    long = op.chunk_ends(shared * 30)  # over several slices: the same ends as in one piece
    assert set((ends[:-1] + 5 * len(shared)).tolist()) - set(long.tolist()) <= set(range(5 * len(shared), 5 * len(shared) + 16))
