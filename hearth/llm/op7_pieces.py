"""SentencePiece encoding with sampled segmentations, and decoding.

A text is a lattice: every vocabulary piece that matches at a position is an edge, and a character without
a piece of its own falls back to its bytes. Spaces are written as U+2581 (a U+2581 of the text itself goes
to bytes), nothing is normalised and no prefix is added, so decoding gives the text back exactly. Pieces
never run from a word into the space after it, so the lattice is a chain of the words' lattices.

The vocabulary file gives ranks, not probabilities; a piece of rank r weighs ``(r + SHIFT) ** -theta``
(Zipf-Mandelbrot), and a segmentation's probability is its weight over the lattice's sum.

``k`` distinct segmentations are drawn without replacement by Gumbel top-k: a best-first search over
prefixes, where a prefix's bound is its largest perturbed log probability. The exact sum of the weights
below a lattice position (one backward pass) gives the bound's distribution, so each sample costs one walk:
the best open bound is the point where the next segmentation leaves an earlier one, and from there the
walk follows the lattice's conditional probabilities. Bounds that share a point are one item until it
is opened. The next bound left over is the threshold for the inclusion scores.

All random numbers are hashes of (seed, row key, sample, word, step), so a row's result does not depend on
partitions, batches or retries. Work is done with arrays over groups of documents of about ``GROUP``
characters; a group's distinct words share one lattice.

Defined results: a null or empty text has one segmentation, the empty one; a text with fewer than k
segmentations gives all it has. A null id is the key "null"; repeated rows give the same samples. An empty
table gives an empty result; other columns are ignored (``encode_best`` keeps none).
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

# --- fixed values
SPACE = 0x2581  # stands for a space in the vocabulary
OWN_SPACE = 0x110000  # a U+2581 of the text; beyond Unicode, so no piece has it
SHIFT = 2.7
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SEED = 42
GROUP = 200_000

CHUNK = re.compile(" *[^ ]+| +")
_U = np.uint64


@dataclass
class Pieces:
    """The vocabulary as arrays: a trie, its piece ids and ranks. The trie's steps (node << 21 | character) lie
    in an open hash table of a power of two."""
    keys: np.ndarray
    nexts: np.ndarray
    piece: np.ndarray
    weight: np.ndarray  # log weight of a node's piece, for theta 1
    byte_ids: np.ndarray
    texts: list[str]
    depth: int
    count: int
    roots: np.ndarray  # character -> node of its step from the root, or -1


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    h = key.astype(_U) * _U(0x9E3779B97F4A7C15)
    return (h >> _U(65 - size.bit_length())).astype(np.int64)


def step_table(keys: list[int], nexts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << (4 * max(1, len(keys)) - 1).bit_length()
    table, to = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    for key, nxt, at in zip(keys, nexts, _slot(np.array(keys, np.int64), size).tolist(), strict=True):
        while table[at] >= 0:
            at = (at + 1) % size
        table[at], to[at] = key, nxt
    return table, to


def step_to(pieces: Pieces, node: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The trie nodes reached from ``node`` by characters ``c``; -1 where there is none."""
    key = (node.astype(np.int64) << 21) | c
    at = _slot(key, len(pieces.keys))
    held = pieces.keys[at]
    out = np.where(held == key, pieces.nexts[at], np.int32(-1))
    todo = np.flatnonzero((held != key) & (held >= 0))
    while len(todo):
        at[todo] = (at[todo] + 1) % len(pieces.keys)
        held = pieces.keys[at[todo]]
        hit = held == key[todo]
        out[todo[hit]] = pieces.nexts[at[todo[hit]]]
        todo = todo[~hit & (held >= 0)]
    return out


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """Read a SentencePiece model on the driver (its size bounds what is sent to the tasks)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
    byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    if any(texts[i] != f"<0x{b:02X}>" for b, i in enumerate(byte_ids)):
        raise ValueError("the vocabulary has no byte pieces")
    plain = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    plain = [i for i in plain if texts[i] and not re.search("[^▁]▁", texts[i])]
    by_score = sorted(plain, key=lambda i: (-sp.get_score(i), i))
    rank = {i: r for r, i in enumerate(by_score)}
    trie: dict[tuple[int, int], int] = {}
    ends: dict[int, int] = {}
    for i in plain:
        at = 0
        for c in texts[i]:
            at = trie.setdefault((at, ord(c)), len(trie) + 1)
        ends[at] = i
    roots = np.full(OWN_SPACE + 1, -1, np.int32)
    for (n, c), to in trie.items():
        if not n:
            roots[c] = to
    keys, nexts = step_table([(n << 21) | c for n, c in trie], list(trie.values()))
    piece = np.full(len(trie) + 1, -1, np.int32)
    ranks = np.zeros(len(trie) + 1)
    for n, i in ends.items():
        piece[n], ranks[n] = i, rank[i]
    return Pieces(keys, nexts, piece, -np.log(ranks + SHIFT), byte_ids, texts, max(len(texts[i]) for i in plain), len(plain), roots)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Mixes ``x`` in place."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _stream(key: np.ndarray, *parts: int) -> np.ndarray:
    """Keys of a row's own stream of random numbers."""
    for p in parts:
        key = _mixed(key + _U(0x9E3779B97F4A7C15 * (p + 1) % (1 << 64)))
    return key


def _uniform(stream: np.ndarray, counter: np.ndarray) -> np.ndarray:
    """The numbers in (0, 1) at the counters of the streams."""
    x = counter.astype(_U)
    x *= _U(0x9E3779B97F4A7C15)
    x = _mixed(x + stream)
    x >>= _U(11)
    u = x.astype(np.float64)
    u += 0.5
    u *= 1.0 / (1 << 53)
    return u


@dataclass
class Lattice:
    """Lattices of a group's distinct words: edges sorted by start, longer ones first, with conditional probabilities."""
    first: np.ndarray  # position -> its first edge; one more entry at the end
    stop: np.ndarray  # edge -> next position, -1 at the word's end
    ids: np.ndarray  # edge -> piece id, or -1 - character for bytes
    prob: np.ndarray
    upto: np.ndarray  # edge -> probability of the position's edges up to and with it
    start: np.ndarray  # edge -> its position
    starts: np.ndarray  # word -> its first position
    best: np.ndarray | None  # position -> its edge on the best path


def build_lattice(words: list[str], pieces: Pieces, theta: float, best_path: bool = False) -> Lattice:
    cp = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    cp = np.where(cp == SPACE, OWN_SPACE, np.where(cp == 32, SPACE, cp))
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size)
    end = np.repeat(ends, size).astype(np.int32)
    n = len(cp)
    at, node, found = np.arange(n, dtype=np.int32), pieces.roots[cp], []
    single = np.zeros(n, bool)
    weight = theta * pieces.weight
    for d in range(pieces.depth):
        if d:
            node = step_to(pieces, node, cp[at + d])
        ok = node >= 0
        at, node = at[ok], node[ok]
        if not len(at):
            break
        which = pieces.piece[node]
        is_piece = which >= 0
        s, m = at[is_piece], node[is_piece]
        if d == 0:
            single[s] = True
        found.append((s, d + 1, which[is_piece], weight[m]))
        more = at + d + 1 < end[at]
        at, node = at[more], node[more]
    lone = np.flatnonzero(~single).astype(np.int32)
    width = np.where(cp[lone] < 0x80, 1, np.where(cp[lone] < 0x800, 2, np.where(cp[lone] < 0x10000, 3, 4)))
    width = np.where(cp[lone] == OWN_SPACE, 3, width)
    low = -theta * math.log(2 * pieces.count + SHIFT)
    byte = np.where(cp[lone] < 0x80, pieces.byte_ids[np.minimum(cp[lone], 0x7F)], -1 - cp[lone])
    found.append((lone, 1, byte.astype(np.int32), low * width))
    # edges by position, longer pieces first: they are mostly the likelier ones, so a walk looks at few
    many = np.zeros(n, np.int64)
    for s, *_ in found:
        many[s] += 1  # a position has one edge of a kind
    first = np.append(0, np.cumsum(many))
    free = first[:-1].copy()
    stop, ids, score = np.empty(first[-1], np.int32), np.empty(first[-1], np.int32), np.empty(first[-1])
    for s, width, which, x in reversed(found):
        to = free[s]
        stop[to], ids[to], score[to] = s + np.int32(width), which, x
        free[s] += 1
    start = np.repeat(np.arange(n, dtype=np.int32), many)
    last = stop == np.repeat(end, many)
    to = np.where(last, np.int32(n), stop)  # the place after all stands for every word's end
    # backward sums, all words at once by the distance to the word's end
    beta, top, best = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n, np.int64)
    dist = end - np.arange(n, dtype=np.int32)
    by = np.argsort(dist.astype(np.int16) if dist.max(initial=0) < 1 << 15 else dist, kind="stable")
    cuts = np.searchsorted(dist[by], np.arange(1, int(dist.max(initial=0)) + 2))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        s = by[a:b]
        count = many[s]
        head = np.cumsum(count) - count
        e = np.repeat(first[s] - head, count) + np.arange(head[-1] + count[-1])
        v = score[e] + beta[to[e]]
        m = np.maximum.reduceat(v, head)
        beta[s] = m + np.log(np.add.reduceat(np.exp(v - np.repeat(m, count)), head))
        if best_path:
            w = score[e] + top[to[e]]
            m = np.maximum.reduceat(w, head)
            top[s] = m
            hit = np.flatnonzero(w == np.repeat(m, count))[::-1]  # of equal paths the one with the longer piece
            best[start[e[hit]]] = e[hit]
    prob = np.exp(score + beta[to] - np.repeat(beta[:-1], many))
    total = np.cumsum(prob)
    upto = total - np.repeat(np.append(0.0, total)[first[:-1]], many)
    upto[first[1:] - 1] = 1.0
    return Lattice(first, np.where(last, np.int32(-1), stop), ids, prob, upto, start, ends - size, best if best_path else None)


def walk(lat: Lattice, at: np.ndarray, draw) -> tuple[np.ndarray, np.ndarray]:
    """Follow edges from positions ``at`` (-1: nothing left) to the words' ends; ``draw(rows, step)`` gives the
    uniform numbers, None the best path. Returns the edges, row by row, and their number per row."""
    rows, step, seen = np.flatnonzero(at >= 0), 0, []
    at = at[rows]
    count = np.zeros(0, np.int64)
    total = np.zeros(int(rows.max(initial=-1)) + 1, np.int64)
    while len(rows):
        if draw is None:
            edge = lat.best[at]
        else:
            edge, u = lat.first[at], draw(rows, step)
            todo = np.flatnonzero(u >= lat.upto[edge])  # a position's last edge reaches 1
            while len(todo):
                edge[todo] += 1
                todo = todo[u[todo] >= lat.upto[edge[todo]]]
        seen.append((rows, edge))
        total[rows] += 1
        nxt = lat.stop[edge]
        go = nxt >= 0
        rows, at, step = rows[go], nxt[go], step + 1
    count = total
    offset = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.int64)
    for s, (r, e) in enumerate(seen):
        out[offset[r] + s] = e
    return out, count


def _padded(count: np.ndarray, n: int) -> np.ndarray:
    return np.append(count, np.zeros(n - len(count), np.int64))


class _Index(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class _Path:
    """One segmentation of every document of a group: edges, their documents' bounds, and the open bounds."""

    def __init__(self, edges, words, steps, heads):
        self.edges, self.words, self.steps, self.heads = edges, words, steps, heads
        self.open = None  # perturbed bound of leaving the path at each edge


def sample_group(texts: list[str], keys: np.ndarray, pieces: Pieces, k: int, theta: float) -> list[list[tuple]]:
    """Per text: up to k tuples (edges' piece ids, log probability, perturbed, log inclusion), best perturbed first."""
    parts = [CHUNK.findall(t) for t in texts]
    docs = len(texts)
    out: list[list[tuple]] = [[] for _ in texts]
    perturbed = -np.log(-np.log(_uniform(_stream(keys, 0), np.zeros(1))))
    many = np.array([len(p) for p in parts])
    for d in np.flatnonzero(many == 0):
        out[d] = [(np.zeros(0, np.int32), 0.0, float(perturbed[d]), 0.0)]
    if not many.any():
        return out
    word, index = pd.factorize(np.array(list(itertools.chain.from_iterable(parts)), object))
    lat = build_lattice(index.tolist(), pieces, theta)
    doc = np.repeat(np.arange(docs), many)
    head = np.cumsum(many) - many  # a document's first word
    nth = np.arange(len(word)) - head[doc]
    logp, choices = np.log(lat.prob), np.diff(lat.first)
    with np.errstate(divide="ignore"):  # log of the mass beside an edge
        beside = np.log(np.where(np.repeat(choices == 1, choices), 0.0, np.maximum(1.0 - lat.prob, 0.0)))
    live = many > 0
    bound = np.where(live, perturbed, -np.inf)  # of the path being drawn
    paths: list[_Path] = []
    chosen: list[dict] = []  # per sample and document: (path, perturbed)
    used: dict[tuple[int, int], list[int]] = {}  # (path, edge's place) -> edges taken there
    leave = None  # where the new path leaves: per document (old path, place in it) and the edge it takes instead
    for j in range(k + 1):
        if j:
            best, whence = np.full(docs, -np.inf), np.full(docs, -1)
            places = np.full(docs, -1)
            for p, path in enumerate(paths):
                some = np.flatnonzero(np.diff(path.heads) > 0)
                if not len(some):
                    continue
                top = np.maximum.reduceat(path.open, path.heads[:-1][some])
                better = top > best[some]
                best[some[better]], whence[some[better]] = top[better], p
            for d in np.flatnonzero(np.isfinite(best)):
                path = paths[whence[d]]
                a, b = path.heads[d], path.heads[d + 1]
                places[d] = a + int(np.argmax(path.open[a:b]))
            bound = best
            if j == k or not np.isfinite(best).any():
                break
        # the positions to walk from: whole documents first, later what follows the leaving edge
        if not j:
            at = lat.starts[word]
            kept = [None] * docs
            mine = live
        else:
            at = np.full(len(word), -1)
            kept, mine = [None] * docs, np.isfinite(bound)
            drawn = _uniform(_stream(keys, 1, j), np.zeros(1)).tolist()
            for d in np.flatnonzero(mine):
                path, place = paths[whence[d]], places[d]
                old = path.edges[place]
                pos = int(lat.start[old])
                taken = used.setdefault((whence[d], place), [int(old)])
                a, b = lat.first[pos], lat.first[pos + 1]
                p = lat.prob[a:b].copy()
                p[np.array(taken) - a] = 0.0
                c = np.cumsum(p)
                u = drawn[d] * c[-1]
                new = int(a + min(np.searchsorted(c, u, "right"), np.flatnonzero(p)[-1]))
                path.open[place] = -np.inf
                w = path.words[place]
                kept[d] = (path, place, new, int(w), taken + [new])
                at[w] = lat.stop[new]
                rest = slice(w + 1, head[d] + many[d])
                at[rest] = lat.starts[word[rest]]
        stream = _stream(keys, 2, j)
        # the counter of a draw: word and step (a word of over a million characters repeats some)
        edges, count = walk(lat, at, lambda r, s, stream=stream: _uniform(stream[doc[r]], (nth[r] << 20) + s % (1 << 20)))
        count = _padded(count, len(word))
        offset = np.append(0, np.cumsum(count))
        owner = np.repeat(np.arange(len(word)), count)
        step = np.arange(len(edges)) - offset[owner]
        if j:
            # prefix and leaving edge go before the newly walked part
            pe, pw, ps, lengths = [], [], [], np.zeros(docs, np.int64)
            for d in range(docs):
                if kept[d] is None:
                    continue
                path, place, new, w, _ = kept[d]
                a, lo, hi = path.heads[d], offset[w], offset[head[d] + many[d]]
                s0 = path.steps[place]
                pe += [path.edges[a:place], [new], edges[lo:hi]]
                pw += [path.words[a:place], [w], owner[lo:hi]]
                ps += [path.steps[a:place], [s0], step[lo:hi] + (owner[lo:hi] == w) * (s0 + 1)]
                lengths[d] = place - a + 1 + hi - lo
            edges, owner, step = (np.concatenate(x).astype(np.int64) for x in (pe, pw, ps))
            heads = np.append(0, np.cumsum(lengths))
        else:
            heads = np.append(0, np.cumsum(np.bincount(doc, count, docs).astype(np.int64)))
        path = _Path(edges, owner, step, heads)
        lengths = np.diff(heads)
        own = np.repeat(np.arange(docs), lengths)
        lp = logp[edges]
        run = np.append(0.0, np.cumsum(lp))
        before = run[:-1] - run[heads[own]]
        total = run[heads[1:]] - run[heads[:-1]]
        # bound of leaving at each edge: a Gumbel of the mass beside it, cut off at the path's own value
        phi = before + beside[edges]
        live_from = heads[:-1].copy()  # bounds before this place belong to the earlier path
        if j:
            for d in np.flatnonzero(lengths):
                _, place, new, _, taken = kept[d]
                here = heads[d] + place - kept[d][0].heads[d]
                pos = int(lat.start[new])
                a, b = lat.first[pos], lat.first[pos + 1]
                rest = float(lat.prob[a:b].sum() - lat.prob[np.array(taken)].sum())
                phi[here] = before[here] + math.log(rest) if len(taken) < b - a and rest > 1e-15 else -np.inf
                live_from[d] = here
                used[(j, int(here))] = taken
        path.open = np.full(len(edges), -np.inf)
        at = np.flatnonzero(np.isfinite(phi) & (np.arange(len(edges)) >= live_from[own])) if j else np.flatnonzero(np.isfinite(phi))
        mine_at = own[at]
        e = _uniform(_stream(keys, 3, j)[mine_at], at - heads[mine_at])
        np.log(e, out=e)
        phi = phi[at]
        with np.errstate(over="ignore"):
            path.open[at] = phi - np.log(np.exp(phi - bound[mine_at]) - e)
        paths.append(path)
        chosen.append({"value": bound.copy(), "total": total, "mine": mine})
    left = bound  # the threshold of the inclusion scores
    for j, (path, c) in enumerate(zip(paths, chosen, strict=True)):
        ids = lat.ids[path.edges]
        for d in np.flatnonzero(c["mine"]):
            lp = float(c["total"][d])
            x = lp - left[d] if np.isfinite(left[d]) else math.inf
            score = 0.0 if x > 30 else x if x < -30 else math.log(-math.expm1(-math.exp(x)))
            out[d].append((_with_bytes(ids[path.heads[d]:path.heads[d + 1]], pieces), lp, float(c["value"][d]), score))
    return out


def _with_bytes(ids: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Characters that fell back to several bytes, as byte pieces."""
    if not (ids < 0).any():
        return ids.astype(np.int32)
    out: list[int] = []
    for i in ids.tolist():
        if i >= 0:
            out.append(i)
        else:
            c = SPACE if -1 - i == OWN_SPACE else -1 - i
            out += pieces.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))].tolist()
    return np.array(out, np.int32)


def best_group(texts: list[str], pieces: Pieces, theta: float) -> list[np.ndarray]:
    """The most probable segmentation of each text."""
    index = _Index()
    parts = [list(map(index.__getitem__, CHUNK.findall(t))) for t in texts]
    if not index:
        return [np.zeros(0, np.int32) for _ in texts]
    lat = build_lattice(list(index), pieces, theta, best_path=True)
    word = np.fromiter(itertools.chain.from_iterable(parts), np.int64)
    edges, count = walk(lat, lat.starts[word], None)
    cut = np.append(0, np.cumsum(_padded(count, len(word))))
    at = np.append(0, np.cumsum([len(p) for p in parts]))
    ids = lat.ids[edges]
    return [_with_bytes(ids[cut[a]:cut[b]], pieces) for a, b in zip(at[:-1], at[1:], strict=True)]


def piece_bytes(pieces: Pieces) -> list[bytes]:
    """What every piece id stands for, in UTF-8."""
    out = [t.replace(chr(SPACE), " ").encode("utf-8", "surrogatepass") for t in pieces.texts]
    for b, i in enumerate(pieces.byte_ids):
        out[int(i)] = bytes((b,))
    return out


def join_pieces(ids, known: list[bytes]) -> bytes:
    return b"".join([known[i] for i in ids])


def decoded(flat: np.ndarray, size: np.ndarray, known: pa.LargeBinaryArray) -> Iterator[bytes]:
    """The texts, in UTF-8, of sequences of piece ids laid end to end; ``size``: ids of each."""
    taken = known.take(pa.array(flat))
    at = np.frombuffer(taken.buffers()[1], np.int64, len(flat) + 1, taken.offset * 8) if len(flat) else np.zeros(1, np.int64)
    whole = memoryview(taken.buffers()[2] or b"") if len(flat) else memoryview(b"")
    cut = at[np.append(0, np.cumsum(size, dtype=np.int64))].tolist()
    return (whole[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True))


def decode_ids(ids, pieces: Pieces) -> str:
    """The text of a sequence of piece ids."""
    return join_pieces(ids, piece_bytes(pieces)).decode("utf-8", "surrogatepass")


def row_keys(ids: list, seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{seed}|{'null' if i is None else i}") for i in ids], np.uint64)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """The ids and texts of a batch, a group at a time: no more of it is held as Python objects."""
    size = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    whole = np.cumsum(size, dtype=np.int64)
    a = 0
    while a < len(size):
        b = min(len(size), int(np.searchsorted(whole, (whole[a - 1] if a else 0) + GROUP)) + 1)
        part = batch.slice(a, b - a)
        yield part.column("doc_id").to_pylist(), [t or "" for t in part.column("text").to_pylist()]
        a = b


def sample_encodings(docs: DataFrame, vocabulary: str = VOCABULARY, k: int = SAMPLES, theta: float = 1.0,
                     seed: int = SEED) -> DataFrame:
    """Up to k rows per document: doc_id, sample (1 to k), ids, n_pieces, log_prob, perturbed, log_inclusion, and
    whether the ids decode to the text (restored)."""
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(load_pieces(vocabulary))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model.value
        known = pa.array(piece_bytes(pieces), pa.large_binary())
        for b in batches:
            for names, texts in _groups(b):
                rows = []
                for d, t, group in zip(names, texts, sample_group(texts, row_keys(names, seed), pieces, k, theta), strict=True):
                    rows += [(d, j + 1, *s, t) for j, s in enumerate(group)]
                ids = [r[2] for r in rows]
                size = np.array([len(x) for x in ids], np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                back = decoded(flat, size, known)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(flat, pa.int32())),
                     pa.array(size), *[pa.array([r[c] for r in rows], pa.float64()) for c in (3, 4, 5)],
                     pa.array([x == r[6].encode("utf-8", "surrogatepass") for x, r in zip(back, rows, strict=True)], pa.bool_())],
                    names=["doc_id", "sample", "ids", "n_pieces", "log_prob", "perturbed", "log_inclusion", "restored"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, sample int, ids array<int>, n_pieces int, log_prob double, perturbed double, log_inclusion double, "
             "restored boolean")


def encode_best(docs: DataFrame, vocabulary: str = VOCABULARY, theta: float = 1.0) -> DataFrame:
    """Per document: doc_id and the ids of its most probable segmentation."""
    model = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for names, texts in _groups(b):
                ids = best_group(texts, model.value, theta)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                                                 names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` (with a column ``ids``) and the decoded ``text``."""
    model = encoded.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))
    kept = encoded.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = piece_bytes(model.value)
        for b in batches:
            text = [None if x is None else join_pieces(x, known).decode("utf-8", "surrogatepass") for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], names=[*b.schema.names, "text"])

    schema = T.StructType([*kept.schema.fields, T.StructField("text", T.StringType())])
    return kept.mapInArrow(run, schema)
