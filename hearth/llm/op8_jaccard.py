"""N-gram Jaccard join: size-aware, heavy-light.

A document's set is its distinct word shingles as 64-bit hashes. Documents with the same set are one
class. Two classes link when ``den * |A & B| >= num * |A | B|``; the result is the connected components.

Candidates are exact (no link is lost). In an order that puts heavy shingles last, a set of size n shares
with every partner one of its first ``n - ceil(t n) + 1`` shingles, and two of its first
``n - ceil(t n) + 2`` (t = num / den). Small sets enumerate the 2-subsets of the latter; large sets, and
the small ones that could have a large partner, enter the former into inverted lists, which are scanned.
The boundary between small and large is the largest size whose subsets cost no more than its list entries
and the partners met there, as measured over all sets.

Heavy shingles are those that repeat most among the sets' first shingles, counted over all documents
within runs of about ``COUNTED``; at most ``HEAVY_MOST`` of them are kept and sent to the tasks (any choice of them gives
the same result, it only changes the work). Very long lists are salted by their measured length.

Lists with the same members count once. First every member is compared with its list's leader. Then, in
lists that still hold several components, pairs of different components are compared: in short lists all of
them; long lists (``LONG_LIST`` members) are cut into blocks, and the pairs of blocks are compared as arrays of
bitmaps within a task, which passes on for each set its two likeliest partners, and in a last round every pair
left that the bitmaps do not rule out. So no list is one task's, and its pairs are not listed; what is connected
already is not compared again, and what is not is compared fully. Bits in which two sets' bitmaps differ bound
their shared shingles from above, so the screening loses no link; the sets of pairs left are computed from the
whole texts again and the pairs verified by exact intersection.

Defined results: null or empty texts, and texts without words: empty set, linked with nothing; texts of
fewer words than a shingle: one shingle, the whole sequence. A null id: its row has its n_shingles and
component null and links nothing. Repeated rows count as copies. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, free, kept_rows, release, small_batches, written

WORDS = 5
NUM, DEN = 75, 100
HEAVY_MOST = 100_000  # shingles sent to the tasks, at most (800 KB)
HEAVY_LEAST = 8  # repeats from which a shingle counts as heavy
COUNTED = 10_000  # documents, at least, among which repeats are counted at once
PASSES = 2  # over the texts, to move the inverted lists in as many shares (each has a small table written after it)
LIST_ROWS = 50_000  # measured length from which a list is salted
SMALL_MOST = 40  # largest boundary tried
BROADCAST_ROWS = 500_000  # wanted (doc_id, sid) rows sent to all tasks, at most (8 MB)
FEW_SETS = 50_000  # sets of a round up to which only their bitmaps and shingles are moved
BITS = 4  # of a bitmap for each shingle, at least; at most twice as many
LONG_LIST = 64  # members from which a list is compared in blocks
BLOCK = 4096  # sets of a long list that a task holds, for each side
KEYS = 1 << 20  # keys of pairs compared at once
STEP = 256  # of them compared with the other side at once
HEAD = 4  # part of the bitmaps, one in so many, that is compared first
BEST = 2  # partners of a set that the first round over long lists passes on, for each pair of blocks
SLAB = 1 << 16  # bytes of texts hashed at once
SEEN = 100_000  # sets that a task remembers, so that copies are not emitted again

_MIX, _MUL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


# of each byte: 0 for ASCII white space, else its value and one, A-Z as small letters (0xFF, in no UTF-8, takes A's place)
_VALUE = bytes(0 if chr(b).isspace() and b < 0x80 and b not in range(0x1C, 0x20) else 1 + (b + 32 if 65 <= b <= 90 else b) if b < 255 else 66
               for b in range(256))
_LONG = 1 << 16
_BASE = 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, np.uint64(base))]), dtype=np.uint64)


_POWERS, _INVERSE = _powers(_BASE, _LONG), _powers(pow(_BASE, -1, 1 << 64), _LONG)
_BY_WORD = np.random.Generator(np.random.PCG64(8)).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(text: bytes, places: bool = False) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word: a polynomial in its bytes, mixed. White space cuts words, A-Z count as small letters.
    With ``places`` also where each word starts."""
    value = np.frombuffer(text.translate(_VALUE), np.uint8)
    edge = value != 0
    edge[1:] &= value[:-1] == 0
    start = np.flatnonzero(edge)
    if not len(start):
        h = np.zeros(0, np.uint64)
        return (h, start) if places else h
    # summed with the powers of the places in the text, then divided by the power of the word's first place
    if len(value) <= _LONG:
        h = np.add.reduceat(value * _POWERS[:len(value)], start) * _INVERSE[start]
    else:
        steps = len(value) // _LONG + 1
        power = (_powers(pow(_BASE, _LONG, 1 << 64), steps)[:, None] * _POWERS).ravel()[:len(value)]
        back = _powers(pow(_BASE, -_LONG, 1 << 64), steps)
        h = np.add.reduceat(value * power, start) * _INVERSE[start & (_LONG - 1)] * back[start // _LONG]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return (h, start) if places else h


def shingle_set(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes (uint64) of a text in UTF-8."""
    return next(shingle_sets([text], words))


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of every run of ``k`` words, given the words' hashes."""
    n = len(h) - k + 1
    x = np.full(n, k, np.uint64)
    for i in range(k):
        x += h[i:i + n] * (_BY_WORD[i] if i < len(_BY_WORD) else _BY_WORD[i % len(_BY_WORD)] + np.uint64(2 * i))
    x ^= x >> np.uint64(31)
    x *= _MUL
    return x


def _slabs(texts: Iterable[bytes | None]) -> Iterator[list[bytes]]:
    slab, held = [], 0
    for t in texts:
        slab.append(t or b"")
        held += len(slab[-1])
        if held >= SLAB:
            yield slab
            slab, held = [], 0
    if slab:
        yield slab


def shingle_sets(texts: Iterable[bytes | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """``shingle_set`` of every text in turn; about ``SLAB`` bytes of texts are hashed at once."""
    for slab in _slabs(texts):
        h, start = word_hashes(b" ".join(slab), places=True)
        ends = np.cumsum([len(t) + 1 for t in slab])
        cuts = np.searchsorted(start, ends).tolist()
        x = _shingles(h, words) if len(h) >= words else h[:0]
        lo = 0
        for hi in cuts:
            if hi - lo >= words:
                s = x[lo:hi - words + 1]
                s.sort()  # its runs of words are no other text's
            else:
                s = _shingles(h[lo:hi], hi - lo) if hi > lo else h[:0]
            lo = hi
            if len(s) > 1:
                fresh = s[1:] != s[:-1]
                if not fresh.all():
                    s = s[np.append(True, fresh)]
            yield s


def set_id(s: np.ndarray) -> int:
    """A signed 64-bit name of a set, mixed with its size."""
    return xxhash.xxh64_intdigest(s.tobytes(), seed=len(s)) - (1 << 63)


def set_bits(s: np.ndarray) -> bytes:
    """Bitmap of a set: ``BITS`` bits for each shingle, up to a power of two, at least 64."""
    m = max(64, 1 << (BITS * len(s) - 1).bit_length()) if len(s) else 64
    bits = np.zeros(m, np.uint8)
    bits[(((s * _MUL) >> np.uint64(20)) & np.uint64(m - 1)).view(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def most_shared(x: bytes, y: bytes, n: int, m: int) -> int:
    """Upper bound of the shingles that sets of sizes n and m share: every bit that differs is a shingle of one only."""
    while len(x) > len(y):
        half = len(x) // 2
        x = (int.from_bytes(x[:half], "little") | int.from_bytes(x[half:], "little")).to_bytes(half, "little")
    while len(y) > len(x):
        half = len(y) // 2
        y = (int.from_bytes(y[:half], "little") | int.from_bytes(y[half:], "little")).to_bytes(half, "little")
    return (n + m - (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count()) // 2


def prefix_length(n: int, shared: int, num: int = NUM, den: int = DEN) -> int:
    """First shingles of which a set of size n shares at least ``shared`` with every partner."""
    return min(n, n + (-num * n // den) + shared)


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    """The texts of a batch, one at a time."""
    return (t.as_py() for t in batch.column("text"))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def set_profiles(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Rows of three kinds: 0 (doc_id, n, sid, bits) per document; 1 (n = repeats, sid = shingle) per run of documents and
    repeated first shingle; 2 (n = first shingles, sid = sum of squared repeats) per run."""
    names = ["kind", "doc_id", "n", "sid", "bits"]

    def repeats(first: list[np.ndarray]) -> pa.RecordBatch:
        u, c = np.unique(np.concatenate(first), return_counts=True)
        often = c > 1
        n = int(often.sum())
        return pa.RecordBatch.from_arrays(
            [pa.array([1] * n + [2], pa.int32()), pa.nulls(n + 1, pa.int64()), pa.array([*c[often].tolist(), int(c.sum())], pa.int64()),
             pa.array([*u[often].view(np.int64).tolist(), int((c.astype(np.int64) ** 2).sum())], pa.int64()),
             pa.nulls(n + 1, pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, seen, rows = [], set(), 0
        for b in batches:
            ids, sizes, sids, maps = b.column("doc_id").to_pylist(), [], [], []
            for s in shingle_sets(_texts(b), words):
                sid = set_id(s)
                sizes.append(len(s))
                sids.append(sid)
                fresh = len(s) > 2 and sid not in seen
                maps.append(set_bits(s) if fresh else None)  # once in a run
                if len(s) and sid not in seen:
                    seen.add(sid)
                    first.append(s[:prefix_length(len(s), 1, num, den)].copy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(ids), np.int32)), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(sids, pa.int64()), pa.array(maps, pa.binary())], names=names)
            rows += len(ids)
            if rows >= COUNTED and first:
                yield repeats(first)
                first, seen, rows = [], set(), 0
        if first:
            yield repeats(first)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "kind int, doc_id long, n long, sid long, bits binary")


def size_boundary(partners: float, num: int = NUM, den: int = DEN) -> int:
    """Largest size whose 2-subsets cost no more than its list entries with ``partners`` met in each."""
    best = 0
    for n in range(3, SMALL_MOST + 1):
        p = prefix_length(n, 2, num, den)
        if p * (p - 1) / 2 <= (1 + partners) * prefix_length(n, 1, num, den):
            best = n
    return best


def heavy_last(s: np.ndarray, heavy: np.ndarray, likely: np.ndarray) -> np.ndarray:
    """A set with its heavy shingles (sorted) behind the others; ``likely`` tells by a shingle's first bits whether it can be one."""
    at = np.flatnonzero(likely[(s >> np.uint64(46)).view(np.int64)])
    if len(at):
        maybe = s[at]
        at = at[heavy[np.minimum(np.searchsorted(heavy, maybe), len(heavy) - 1)] == maybe]
    if not len(at):
        return s
    light = np.ones(len(s), bool)
    light[at] = False
    return np.concatenate([s[light], s[at]])


def _salted(key: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """The name of a key's part; the same with that name and the salt gives the key again. Salt 0: the key."""
    return key ^ (salt.astype(np.uint64) * _MIX).view(np.int64)


def list_entries(docs: DataFrame, heavy: np.ndarray, counts: np.ndarray, boundary: int, words: int = WORDS,
                 num: int = NUM, den: int = DEN, part: int = 0, parts: int = 1) -> DataFrame:
    """Rows (list, salt, sid, n): inverted list entries and enumerated 2-subsets of every set; of ``parts`` equal
    shares of all keys the one numbered ``part``. ``list`` is the key with the salt mixed in (``_salted``), so one column sorts the lists."""
    known = docs.sparkSession.sparkContext.broadcast((heavy, np.maximum(1, counts // LIST_ROWS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (heavy, salts), seen = known.value, set()
        likely = np.zeros(1 << 18, bool)  # by the first bits of a shingle: whether it can be heavy
        likely[(heavy >> np.uint64(46)).view(np.int64)] = True
        long, splits = heavy[salts > 1], salts[salts > 1]

        def salts_of(x: np.ndarray) -> np.ndarray:
            """In how many parts the lists of the shingles x are kept."""
            at = np.minimum(np.searchsorted(long, x), len(long) - 1)
            return np.where(long[at] == x, splits[at], 1)

        for b in _slices(batches):
            keys, owners, sizes, cut = [], [], [], []
            for s, doc_id in zip(shingle_sets(_texts(b), words), b.column("doc_id").to_pylist(), strict=True):
                n = len(s)
                if n < 3 or doc_id is None:  # sets of one or two shingles have no partner but their copies
                    continue
                sid = set_id(s)
                if sid in seen:
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(sid)
                s = heavy_last(s, heavy, likely)
                if n > boundary or -(-num * (boundary + 1) // den) <= n:
                    keys.append(s[:prefix_length(n, 1, num, den)])
                    owners.append(sid)
                    sizes.append(n)
                    if len(long):
                        cut.append(salts_of(keys[-1]))
                if n <= boundary:
                    p = s[:prefix_length(n, 2, num, den)]
                    i, j = np.triu_indices(len(p), 1)
                    pair = (p[i] * _MIX) ^ (p[j] * _MUL)
                    keys.append(pair ^ (pair >> np.uint64(31)))
                    owners.append(sid)
                    sizes.append(n)
                    if len(long):  # a pair's list is no longer than either shingle's
                        k = salts_of(p)
                        cut.append(np.minimum(k[i], k[j]))
            if not keys:
                continue
            lengths = [len(x) for x in keys]
            key, owner = np.concatenate(keys), np.repeat(np.array(owners, np.int64), lengths)
            n = np.repeat(np.array(sizes, np.int32), lengths)
            salt = np.zeros(len(key), np.int32)
            if cut:
                k = np.concatenate(cut)
                salt = np.where(k > 1, 1 + owner % k, 0).astype(np.int32)
            if parts > 1:
                mine = (key >> np.uint64(7)) % np.uint64(parts) == np.uint64(part)
                key, salt, owner, n = key[mine], salt[mine], owner[mine], n[mine]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_salted(key.view(np.int64), salt)), pa.array(salt), pa.array(owner), pa.array(n)],
                names=["list", "salt", "sid", "n"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "list long, salt int, sid long, n int")


def list_members(entries: DataFrame) -> DataFrame:
    """Rows (key, sid, n, leader, leader_n) of the lists with two sets or more (a salted list's leaders are
    those of its parts). Spark sorts by the one column ``list`` (radix sort); a task holds an Arrow batch and the
    distinct members of one list or part, which salting keeps to about ``LIST_ROWS``."""
    def closed(name: np.ndarray, salt: np.ndarray, sid: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        """The members of whole lists; repeats of a set go."""
        def used() -> np.ndarray:
            start = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
            size = np.diff(np.append(start, len(name)))
            return np.repeat(size > 1, size) | (salt > 0)  # a part of a salted list has its partners elsewhere

        use = used()
        name, salt, sid, n = name[use], salt[use], sid[use], n[use]
        if len(name):
            order = np.lexsort((sid, name))
            name, salt, sid, n = name[order], salt[order], sid[order], n[order]
            use = np.append(True, (name[1:] != name[:-1]) | (sid[1:] != sid[:-1]))
            name, salt, sid, n = name[use], salt[use], sid[use], n[use]
            use = used()
            name, salt, sid, n = name[use], salt[use], sid[use], n[use]
        start = np.flatnonzero(np.append(True, name[1:] != name[:-1])) if len(name) else np.zeros(0, np.int64)
        lead = np.repeat(start, np.diff(np.append(start, len(name))))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (_salted(name, salt), sid, n, sid[lead], n[lead])],
                                          names=["key", "sid", "n", "leader", "leader_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, most = [], 0, KEYS  # chunks of the open list
        for b in batches:
            chunk = [b.column(c).to_numpy(zero_copy_only=False) for c in ("list", "salt", "sid", "n")]
            if not len(chunk[0]):
                continue
            if held and chunk[0][-1] == held[0][0][0]:
                held.append(chunk)
                rows += len(chunk[0])
                if rows > most:  # a long list's repeats go before it is whole
                    chunk = [np.concatenate(x) for x in zip(*held, strict=True)]
                    at = np.unique(chunk[2], return_index=True)[1]
                    held = [[x[at] for x in chunk]]
                    rows, most = len(at), max(KEYS, 2 * len(at))
                continue
            chunk = [np.concatenate(x) for x in zip(*held, chunk, strict=True)]
            at = int(np.searchsorted(chunk[0], chunk[0][-1]))
            if at:
                yield closed(*(x[:at] for x in chunk))
            held, rows, most = [[x[at:].copy() for x in chunk]], len(chunk[0]) - at, KEYS
        if held:
            yield closed(*(np.concatenate(x) for x in zip(*held, strict=True)))

    ordered = entries.repartition("list").sortWithinPartitions("list")
    return ordered.mapInArrow(run, "key long, sid long, n int, leader long, leader_n int")


def candidate_sets(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """(sid, hashes) of the wanted sets, computed again from the texts of one document each (doc_id, sid)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            sids, sets = [], []
            for s, sid in zip(shingle_sets(_texts(b), words), b.column("sid").to_pylist(), strict=True):
                if set_id(s) == sid:  # another row may bear the same id
                    sids.append(sid)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(sets, pa.binary())], names=["sid", "hashes"])

    if wanted.count() <= BROADCAST_ROWS:  # else both sides are shuffled
        wanted = F.broadcast(wanted)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).join(wanted, "doc_id").select("sid", "text")
    return rows.mapInArrow(run, "sid long, hashes binary").dropDuplicates(["sid"])


def narrowed(table: DataFrame, ids: DataFrame) -> DataFrame:
    """``table`` for a join on ``sid`` with ``ids``: of few sets only their rows, so that a shuffle moves no others."""
    return table if ids.count() > FEW_SETS else table.join(F.broadcast(ids), "sid", "left_semi")


def _sets_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()


def screened(pairs: DataFrame, bits: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """The pairs (a, b) that the sets' bitmaps do not rule out; ``bits`` has sid, n, bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, n, m in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "n", "m")), strict=True):
                most = most_shared(x, y, n, m)
                keep.append(den * most >= num * (n + m - most))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(bits.select(F.col("sid").alias("b"), F.col("bits").alias("y"), F.col("n").alias("m")), "b")
    both = one.join(bits.select(F.col("sid").alias("a"), F.col("bits").alias("x"), "n"), "a")
    return both.select("a", "b", "x", "y", "n", "m").mapInArrow(run, "a long, b long")


class Verifier:
    """Verifies pairs of sets exactly; computes each set that is needed once, from the text of one document."""

    def __init__(self, docs: DataFrame, first: DataFrame, bits: DataFrame, words: int, num: int, den: int):
        self.docs, self.first, self.bits, self.words, self.num, self.den = docs, first, bits, words, num, den
        self.sets: DataFrame | None = None
        self.parts: list[DataFrame] = []

    def links(self, pairs: DataFrame) -> DataFrame:
        left = written(screened(pairs, narrowed(self.bits, _sets_of(pairs)), self.num, self.den), "screened", few=True)
        release(self.docs.sparkSession)
        ids = _sets_of(left)
        if self.sets is not None:
            ids = ids.join(self.sets.select("sid"), "sid", "left_anti")
        ids = written(ids.join(self.first, "sid").select(F.col("first_id").alias("doc_id"), "sid"), "wanted", few=True)
        if not ids.isEmpty():
            more = written(candidate_sets(self.docs, ids, self.words), "sets", few=True)
            self.parts.append(more)
            self.sets = more if self.sets is None else self.sets.unionByName(more)
        if self.sets is None:
            return left
        sets = narrowed(self.sets, _sets_of(left))
        out = written(verified(left, sets, self.num, self.den).where("linked").select("a", "b"), "links", few=True)
        free(left, ids)
        return out


def verified(pairs: DataFrame, sets: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """The pairs (a, b) with column ``linked``: exact intersection of the whole sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                shared = int((q[np.minimum(at, len(q) - 1)] == p).sum()) if len(q) else 0
                linked.append(den * shared >= num * (len(p) + len(q) - shared) and shared > 0)
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), b.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    one = pairs.join(sets.select(F.col("sid").alias("b"), F.col("hashes").alias("y")), "b")
    both = one.join(sets.select(F.col("sid").alias("a"), F.col("hashes").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def _fits(n, m, num: int, den: int):
    """Whether sizes alone allow a link."""
    return (F.least(n, m) * den >= F.greatest(n, m) * num)


def _pair(x, y):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def distinct_lists(members: DataFrame) -> DataFrame:
    """``members`` of one list for each set of members, with the list's length ``m``."""
    sign = members.groupBy("key").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("sid")).alias("x"),
                                      F.bit_xor(F.xxhash64(F.lit(1), "sid")).alias("y"))
    kept = sign.groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key", "m")
    return members.join(kept, "key")


def _mixed(members: DataFrame, tied: DataFrame) -> DataFrame:
    """(key, m, sid, n, c) of the lists that hold several components."""
    label = members.select("key", "m", "sid", "n").join(tied.withColumnRenamed("node", "sid"), "sid", "left").select(
        "key", "m", "sid", "n", F.coalesce("component", "sid").alias("c"))
    several = label.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
    return label.join(several, "key")


def _folded(x: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows of uint64) of that width: halves laid over each other."""
    while x.shape[1] > width:
        half = x.shape[1] // 2
        x = x[:, :half] | x[:, half:]
    return x


def _bits_apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which each row of x differs from each row of y (rows of uint64 of one width)."""
    out = np.zeros((len(x), len(y)), np.int32)
    y = np.ascontiguousarray(y.T)
    step = max(1, 32_768 // max(1, y.shape[1]))
    for a in range(0, len(x), step):
        part, rows = x[a:a + step], out[a:a + step]
        for i in range(x.shape[1]):
            rows += np.bitwise_count(part[:, i, None] ^ y[i])
    return out


def _row_bits_apart(x: np.ndarray, p: np.ndarray, y: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Bits in which the rows p of x differ from the rows q of y, pair by pair."""
    out = np.empty(len(p), np.int64)
    step = max(1, KEYS // x.shape[1])
    for a in range(0, len(p), step):
        out[a:a + step] = np.bitwise_count(x[p[a:a + step]] ^ y[q[a:a + step]]).sum(axis=1, dtype=np.int64)
    return out


def block_pairs(rows: tuple[list, list], same: bool, key: int, best: int | None, num: int, den: int) -> list[tuple[int, int]]:
    """Pairs (sid, sid) of different components that bitmaps do not rule out; rows are (sid, n, c, bits, keys).
    A pair counts at its first common key only. With ``best`` only that many likeliest partners of each set."""
    sides = (rows[0], rows[0]) if same else rows
    sid, n, c = ([np.array([r[i] for r in side], np.int64) for side in sides] for i in range(3))
    classes = []
    for side in sides:
        by: dict[int, list[int]] = {}
        for i, r in enumerate(side):
            by.setdefault(len(r[3]), []).append(i)
        for at in by.values():
            at.sort(key=lambda i: side[i][1])  # by size: partners of a set are a run of the other side
        classes.append({k: (np.array(at), np.array([np.frombuffer(side[i][3], np.uint64) for i in at])) for k, at in by.items()})
    found = []
    for k, (at, x) in classes[0].items():
        for j, (to, y) in classes[1].items():
            if not (k <= 2 * j and j <= 2 * k):  # sizes too far apart to link
                continue
            sizes, width = n[1][to], min(x.shape[1], y.shape[1])
            near, far = _folded(x, width), _folded(y, width)
            head = -(-width // HEAD)  # bits that differ there rule out most pairs
            for a in range(0, len(at), STEP):
                part = at[a:a + STEP]
                small, large = int(n[0][part[0]]), int(n[0][part[-1]])
                lo, hi = np.searchsorted(sizes, [-(-num * small // den), den * large // num + 1])
                if lo >= hi:
                    continue
                other = to[lo:hi]
                u, v = n[0][part][:, None], n[1][other][None, :]
                most = (u + v - _bits_apart(near[a:a + STEP, :head], far[lo:hi, :head])) // 2
                ok = (den * most >= num * (u + v - most)) & (den * np.minimum(u, v) >= num * np.maximum(u, v))
                ok &= c[0][part][:, None] != c[1][other][None, :]
                p, q = np.nonzero(ok)
                both = n[0][part[p]] + n[1][other[q]]
                most = (both - _row_bits_apart(near[a:a + STEP], p, far[lo:hi], q)) // 2
                ok = den * most >= num * (both - most)
                p, q, both, most = p[ok], q[ok], both[ok], most[ok]
                found.append((part[p], other[q], most / (both - most)))
    if not found:
        return []
    p, q, score = (np.concatenate(x) for x in zip(*found, strict=True))
    if same:
        one = p < q
        p, q, score = p[one], q[one], score[one]
    if len(p):
        width = max(len(r[4]) for side in sides for r in side)
        ka, kb = (np.array([r[4] + [r[4][0]] * (width - len(r[4])) for r in side], np.int64) for side in sides)
        first = np.ones(len(p), bool)
        many = max(1, KEYS // width)  # pairs at once
        for a in range(0, len(p), many):
            u, v = ka[p[a:a + many]], kb[q[a:a + many]]
            low = np.full(len(u), np.iinfo(np.int64).max)
            for i in range(width):
                low = np.where((v == u[:, i:i + 1]).any(axis=1) & (u[:, i] < low), u[:, i], low)
            first[a:a + many] = low == key
        p, q, score = p[first], q[first], score[first]
    if best is not None:
        keep = np.zeros(len(p), bool)
        for one in (p, q):
            order = np.lexsort((-score, one))
            start = np.flatnonzero(np.append(True, one[order][1:] != one[order][:-1]))
            rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
            keep[order[rank < best]] = True
        p, q = p[keep], q[keep]
    return list(zip(sid[0][p].tolist(), sid[1][q].tolist(), strict=True))


def long_list_pairs(members: DataFrame, tied: DataFrame, bits: DataFrame, best: int | None, num: int = NUM,
                    den: int = DEN) -> DataFrame:
    """Candidate pairs (a, b) of the long lists, compared block by block (written)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out = None, ([], []), []

        def flushed() -> pa.RecordBatch:
            a = np.array(out, np.int64).reshape(-1, 2)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a.min(axis=1, initial=np.iinfo(np.int64).max)),
                                               pa.array(a.max(axis=1, initial=np.iinfo(np.int64).min))], names=["a", "b"])

        def finish() -> None:
            if group is not None and rows[0] and (group[1] == group[2] or rows[1]):
                out.extend(block_pairs(rows, group[1] == group[2], group[0], best, num, den))

        for b in batches:
            for k, p, q, side, *row in zip(*(b.column(x).to_pylist() for x in (
                    "key", "p", "q", "side", "sid", "n", "c", "bits", "keys")), strict=True):
                if (k, p, q) != group:
                    finish()
                    group, rows = (k, p, q), ([], [])
                    if len(out) > 100_000:
                        yield flushed()
                rows[side].append(row)
        finish()
        yield flushed()

    open_ = written(_mixed(members, tied), "open", few=True)
    blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
    held = open_.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("mine")).alias("p"), F.greatest(o, F.col("mine")).alias("q"))))
    held = held.withColumn("pair", pair).select("key", "pair.p", "pair.q", F.when(
        F.col("mine") == F.col("pair.p"), 0).otherwise(1).alias("side"), "sid", "n", "c")
    mine = narrowed(bits.select("sid", "bits"), open_.select("sid").distinct())
    own = open_.groupBy("sid").agg(F.collect_list("key").alias("keys")).join(mine, "sid")
    pairs = written(held.join(own, "sid").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "side")
                    .mapInArrow(run, "a long, b long").distinct(), "compared", few=True)
    free(open_)
    return pairs


def link_components(members: DataFrame, verifier: Verifier, num: int = NUM, den: int = DEN) -> DataFrame:
    """(node, component) over the sets that link with another set; ``members`` as from ``distinct_lists``."""
    star = (members.where(F.col("sid") != F.col("leader")).where(_fits(F.col("n"), F.col("leader_n"), num, den))
            .select(*_pair(F.col("sid"), F.col("leader"))).distinct())
    known = [written(star, "pairs", few=True)]
    links = verifier.links(known[0])
    tied = components(links)
    free(links)
    for step in ("short", "likeliest", "all"):
        compared = None
        if step == "short":
            open_ = _mixed(members.where(F.col("m") < LONG_LIST), tied)
            other = open_.select("key", F.col("sid").alias("t"), F.col("n").alias("tn"), F.col("c").alias("tc"))
            pairs = (open_.join(other, "key").where("sid < t and c <> tc").where(_fits(F.col("n"), F.col("tn"), num, den))
                     .select(*_pair(F.col("sid"), F.col("t"))).distinct())
        else:
            pairs = compared = long_list_pairs(members.where(F.col("m") >= LONG_LIST), tied, verifier.bits,
                                               BEST if step == "likeliest" else None, num, den)
        for met in known:
            pairs = pairs.join(met, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs", few=True)
        free(compared)
        known.append(pairs)
        if pairs.isEmpty():
            continue
        links = verifier.links(pairs)
        if not links.isEmpty():
            before, tied = tied, components(tied.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))
            free(before)
        free(links)
    free(*known)
    return tied


def set_components(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Per row: doc_id, n_shingles, sid, component_id (the smallest doc_id reachable by links)."""
    small_batches(docs.sparkSession)
    rows = written(set_profiles(docs, words, num, den), "profiles")
    own = rows.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "sid")
    heavy = (rows.where("kind = 1").groupBy("sid").agg(F.sum("n").alias("c")).where(F.col("c") >= HEAVY_LEAST)
             .orderBy(F.desc("c"), "sid").limit(HEAVY_MOST).collect())
    heavy.sort(key=lambda r: r["sid"] & ((1 << 64) - 1))
    names = np.array([r["sid"] for r in heavy], np.int64).view(np.uint64)
    total, squares = rows.where("kind = 2").agg(F.sum("n"), F.sum("sid")).first()
    boundary = size_boundary(squares / total - 1 if total else 0.0, num, den)
    counts = np.array([r["c"] for r in heavy], np.int64)
    # the entries are by far the largest shuffle: each pass over the texts moves the lists of one share of the keys
    # the session's listeners hold a plan until a later one ends, so a pass's shuffle files go after one more small table
    first = own.where("n_shingles > 0 and doc_id is not null").groupBy("sid").agg(F.min("doc_id").alias("first_id"))
    beside, shares = {"classes": first, "own": own}, []
    for part in range(PASSES):
        entries = list_entries(docs, names, counts, boundary, words, num, den, part, PASSES)
        shares.append(written(list_members(entries), "lists"))
        name = ("classes", "own")[part]
        beside[name] = written(beside[name], name, few=True)
        release(docs.sparkSession)
    first, own = beside["classes"], beside["own"]
    lists = shares[0]
    for more in shares[1:]:
        lists = lists.unionByName(more)
    members = written(distinct_lists(lists), "lists", few=True)
    free(*shares)
    bits = (rows.where("kind = 0 and bits is not null").select("sid", "n", "bits")
            .join(members.select("sid").distinct(), "sid", "left_semi").dropDuplicates(["sid"]))
    bits = written(bits, "bits", few=True)
    free(rows)
    verifier = Verifier(docs, first, bits, words, num, den)
    tied = link_components(members, verifier, num, den).withColumnRenamed("node", "sid")
    free(members, bits, *verifier.parts)
    # the smallest id of a component: combined before the shuffle; its join back has one row a component, split by AQE if hot
    low = tied.join(first, "sid").groupBy("component").agg(F.min("first_id").alias("low"))
    named = first.join(tied, "sid", "left").join(low, "component", "left").select(
        "sid", F.coalesce("low", "first_id").alias("low"))
    out = own.join(named, "sid", "left")
    return out.select("doc_id", "n_shingles", "sid", F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("low")))
                      .otherwise(F.col("doc_id")).cast("long").alias("component_id"))


def jaccard_components(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    return set_components(docs, words, num, den).drop("sid")


def _set_key(words: int):
    """A column function: the id of a text's set, null for an empty set."""
    @F.pandas_udf("long")
    def key(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            s = shingle_set(t.encode("utf-8", "surrogatepass") if isinstance(t, str) else None, words)
            out.append(set_id(s) if len(s) else None)
        return pd.Series(out, index=texts.index, dtype="Int64")

    return key


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` with one row of each component (of the smallest id); all columns stay.

    Rows are decided by id and set: a repeated id loses only the sets in another id's component, and of its
    sets in its own component the one with the smallest set id stays. Rows that link with nothing (null ids, empty
    sets) all stay.
    """
    found = written(set_components(docs, words, num, den).where("doc_id is not null"), "found", few=True)
    some = F.col("n_shingles") > 0
    low = (found.where(some & (F.col("component_id") == F.col("doc_id"))).groupBy("doc_id")
           .agg(F.min("sid").alias("low")))
    placed = found.join(low, "doc_id", "left").select(
        "doc_id", F.when(some, F.col("sid")).alias("key"), F.lit(1).alias("rows"),
        (~some | F.coalesce(F.col("sid") == F.col("low"), F.lit(False))
         & (F.col("component_id") == F.col("doc_id"))).alias("kept"))
    return kept_rows(docs, placed, _set_key(words)(F.col("text")))
