"""Fill-in-middle transformation over content-defined chunks.

A text is cut at random places, drawn from its id, into prefix, middle and suffix, which are put in one of two orders
with markers between them (psm, spm), or left alone (plain). Cuts count code points.

Texts are handled as UTF-8. A rolling hash over the last ``WINDOW`` bytes names chunk ends, so a passage that many
texts share falls into the same chunks in each of them (but for its edges). A chunk's boundary summary holds the code
points that begin in it, whether a marker lies in it, and its first and last bytes, for markers that straddle an end.
Each task keeps the summaries of the chunks it has met, found by the chunk's hash and verified by its whole content, in
a memory of ``MEMO_BYTES`` at most (cleared when full; then summaries are only computed again). A text's length and
whether it holds a marker follow from its chunks' summaries; a cut is found by the running sum of the counts and a
search within the one chunk that holds it.

Defined results: a null text is empty. An empty text, one that contains a marker and one not drawn for the
transformation are plain: the output is the text. A null id draws as the word ``null``. Repeated rows give the same
output. Very long texts are chunked in slices. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
SEED = "1"
TRANSFORMED = 90  # of 100 texts
SUFFIX_FIRST = 20  # of 100 transformed texts
WINDOW = 16  # bytes of the rolling hash; the steps below double up to it
ENDS = 0x3FF << 12  # hash bits that are all zero at a chunk's end: chunks of 1 KB in the mean
LONGEST = 1 << 14  # bytes of a chunk, at most
SLICE = 1 << 20  # bytes of a text that are hashed at once
MEMO_BYTES = 32 << 20

_GEAR = np.random.Generator(np.random.PCG64(12)).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_ends(text: bytes) -> np.ndarray:
    """Ends (exclusive) of the chunks of a text; the last one is the text's end."""
    found = []
    for at in range(0, len(text), SLICE):
        lead = min(at, WINDOW - 1)  # bytes before the slice that its first windows reach back to
        h = _GEAR[np.frombuffer(text, np.uint8, min(SLICE, len(text) - at) + lead, at - lead)]
        step = 1
        while step < WINDOW:  # the sum over a window twice as long
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
            step *= 2
        hit = np.flatnonzero((h & np.uint32(ENDS)) == 0)
        found.append(hit[hit >= lead] + (at - lead + 1))
    ends = np.concatenate([*found, [len(text)]]).astype(np.int64) if text else np.zeros(0, np.int64)
    ends = np.unique(ends)
    gap = np.diff(ends, prepend=0)
    if len(gap) and gap.max() > LONGEST:  # stretches without an end are cut evenly
        ends = np.unique(np.concatenate([ends, *(np.arange(e - g + LONGEST, e, LONGEST) for e, g in zip(
            ends[gap > LONGEST].tolist(), gap[gap > LONGEST].tolist(), strict=True))]))
    return ends


def code_points(data: bytes) -> int:
    """Code points that begin in ``data``: all bytes but continuation bytes."""
    b = np.frombuffer(data, np.uint8)
    return len(b) - int(((b & 0xC0) == 0x80).sum())


class ChunkMemo(dict):
    """Boundary summaries (code points, holds a marker, first bytes, last bytes) by chunk content.

    A chunk is found by the hash of its bytes and counts as met before only if all its bytes are equal.
    """

    def __init__(self, limit: int = MEMO_BYTES):
        super().__init__()
        self.limit, self.held, self.computed = limit, 0, 0

    def __missing__(self, chunk: bytes) -> tuple[int, bool, bytes, bytes]:
        if self.held + len(chunk) > self.limit:
            self.clear()
            self.held = 0
        self.held += len(chunk)
        self.computed += 1
        s = self[chunk] = (code_points(chunk), any(m in chunk for m in MARKERS), chunk[:2], chunk[-2:])
        return s


def text_summary(text: bytes, memo: ChunkMemo) -> tuple[np.ndarray, np.ndarray, bool]:
    """(chunk ends, code points up to each chunk's end, whether the text holds a marker), combined from the chunks."""
    ends = chunk_ends(text)
    counts, marked, tail, at = [], False, b"", 0
    for end in ends.tolist():
        n, inside, head, last = memo[text[at:end]]
        counts.append(n)
        joined = tail + head
        marked = marked or inside or any(m in joined for m in MARKERS)
        tail = last if end - at >= 2 else (tail + last)[-2:]
        at = end
    return ends, np.cumsum(np.array(counts, np.int64)), marked


def byte_of(text: bytes, point: int, ends: np.ndarray, upto: np.ndarray) -> int:
    """The byte at which code point number ``point`` begins (the text's end for one past the last)."""
    if not len(ends) or point >= upto[-1]:
        return len(text)
    k = int(np.searchsorted(upto, point, side="right"))  # the chunk in which it begins
    at, before = (int(ends[k - 1]), int(upto[k - 1])) if k else (0, 0)
    b = np.frombuffer(text, np.uint8, int(ends[k]) - at, at)
    return at + int(np.flatnonzero((b & 0xC0) != 0x80)[point - before])


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """Four 32-bit numbers of a row."""
    h = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in (0, 8, 16, 24)]


def transform(text: bytes, doc_id: int | None, memo: ChunkMemo, seed: str = SEED) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix's code points, middle's code points, output) of one text."""
    ends, upto, marked = text_summary(text, memo)
    n = int(upto[-1]) if len(upto) else 0
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or marked or h3 % 100 >= TRANSFORMED:
        return n, "plain", None, None, text
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = byte_of(text, lo, ends, upto), byte_of(text, hi, ends, upto)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKERS
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", lo, hi - lo, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", lo, hi - lo, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars, output (the transformed text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = ChunkMemo()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(ids), 256):  # so many outputs in memory at once
                rows = [transform(t.as_py() or b"", i, memo, seed) for i, t in zip(ids[at:at + 256], texts[at:at + 256], strict=True)]
                n, form, prefix, middle, out = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:at + 256], pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.binary())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form. A transformed text holds no marker, so each marker stands once."""
    def part(a: str, b: str | None) -> Column:
        rest = F.substring_index(output, a, -1)
        return F.substring_index(rest, b, 1) if b else rest

    psm = F.concat(part(PREFIX, SUFFIX), part(MIDDLE, None), part(SUFFIX, MIDDLE))
    spm = F.concat(part(PREFIX, MIDDLE), part(MIDDLE, None), part(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def middle_digest(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars and the digests of the output and of the text rebuilt from it."""
    return fill_in_middle(docs, seed).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
