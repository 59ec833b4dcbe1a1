"""Embedding near-dedup by cross-polytope hashing.

Equal vectors of a label are one class. Every class vector is padded to a power of two, turned by three
rounds of random signs and the fast Hadamard transform, and named by its largest coordinate and that
coordinate's sign (a vertex of the cross-polytope). ``polytopes`` such names make one key of a table, and
each vector enters ``TABLES`` tables by its own key and by ``PROBES`` more keys, in which its least certain
polytope takes the second largest coordinate. The number of polytopes follows from the number of classes,
so that unrelated vectors seldom share a key.

Vectors that share a key are compared in double precision. A bucket is never one task's: it is cut into
blocks of ``BLOCK`` vectors and the pairs of blocks are compared as matrices. Linked pairs are not listed:
every vector's links are counted in place (a pair counts at the first key it shares, so once), and a
block pair sends on one spanning tree of its links for the components.

Defined results: a null label, a null, empty or zero vector, or one with null or non-finite components
links with nothing (n_links 0, its own component, kept). Vectors of different lengths never link. Rows
with the same id count as copies of one another if their vectors are equal; a null id takes part as a
copy and has component null where it is alone. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, written

COSINE = 0.98
TABLES = 10
PROBES = 3
BLOCK = 1024
SEED = 42


def polytopes_for(classes: int, dim: int) -> int:
    """Polytopes in a key: one more than name as many buckets as there are classes."""
    return max(2, math.ceil(math.log(max(2, classes)) / math.log(2 * max(2, dim))) + 1)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (length a power of two), orthonormal."""
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision (first by the largest component, so nothing overflows)."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def hash_keys(x: np.ndarray, polytopes: int, tables: int = TABLES, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """Keys (rows, tables * (1 + probes)) of unit rows; a key holds its table's number."""
    n = 1 << max(1, (x.shape[1] - 1).bit_length())
    pad = np.zeros((len(x), n))
    pad[:, :x.shape[1]] = x
    rng = np.random.Generator(np.random.PCG64(seed))
    rows = np.arange(len(x))
    out = []
    for t in range(tables):
        names, seconds, margins = [], [], []
        for _ in range(polytopes):
            y = pad
            for _ in range(3):
                y = hadamard(y * rng.choice((-1.0, 1.0), n))
            a = np.abs(y)
            two = np.argpartition(-a, 1, axis=1)[:, :2]
            first = np.where(a[rows, two[:, 0]] >= a[rows, two[:, 1]], two[:, 0], two[:, 1])
            second = two.sum(axis=1) - first
            margins.append(a[rows, first] - a[rows, second])
            names.append(2 * first + (y[rows, first] < 0))
            seconds.append(2 * second + (y[rows, second] < 0))
        names, seconds = np.array(names, np.uint64), np.array(seconds, np.uint64)
        order = np.argsort(np.array(margins), axis=0, kind="stable")
        # own key, then the least certain polytope's second name, the next one's, and both
        flips = [(), (0,), (1,), (0, 1), (2,)] if polytopes > 2 else [(), (0,), (1,), (0, 1)]
        for flip in flips[:1 + probes]:
            use = names.copy()
            for f in flip:
                use[order[f], rows] = seconds[order[f], rows]
            key = np.full(len(x), t + 1, np.uint64)
            for name in use:
                key = key * np.uint64(2 * n + 1) + name
                key = (key ^ (key >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
            out.append(key)
    return np.array(out, np.uint64).T


def vector_classes(vectors: DataFrame) -> DataFrame:
    """(label, embedding as doubles, cid = smallest id, copies) of the vectors that can link."""
    v = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    fine = (F.col("label").isNotNull() & (F.size("embedding") > 0)
            & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
            & F.exists("embedding", lambda c: c != 0))
    # adding zero makes negative zero plain, so that equal vectors group
    v = v.where(fine).withColumn("embedding", F.transform("embedding", lambda c: c + F.lit(0.0)))
    return v.groupBy("label", "embedding").agg(F.min("vec_id").alias("cid"), F.count("*").alias("copies"))


def bucket_rows(classes: DataFrame, polytopes: int, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """(cid, keys): the keys of each class, salted with label and length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cid, label, vec = b.column("cid").to_pylist(), b.column("label").to_pylist(), b.column("embedding").to_pylist()
            by: dict[int, list[int]] = {}
            for i, v in enumerate(vec):
                by.setdefault(len(v), []).append(i)
            for n, rows in by.items():
                keys = hash_keys(unit_rows(np.array([vec[i] for i in rows], float)), polytopes, tables, probes)
                salt = np.array([xxhash.xxh64_intdigest(f"{label[i]}|{n}") for i in rows], np.uint64)
                keys = (keys ^ salt[:, None]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cid[i] for i in rows], pa.int64()), pa.array(list(keys), pa.list_(pa.int64()))],
                    names=["cid", "keys"])

    return classes.select(F.col("cid").cast("long"), F.col("label").cast("string").alias("label"), "embedding").mapInArrow(
        run, "cid long, keys array<long>")


def _find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _block_links(key: int, a: list, b: list | None, cosine: float):
    """Links of one pair of blocks: (cids, weighted counts, tree edges). A pair counts if ``key`` is its first shared key."""
    xa, ka = np.array([r[1] for r in a]), np.array([r[2] for r in a])
    if b is None:
        xb, kb, b = xa, ka, a
        i, j = np.nonzero(np.triu(unit_rows(xa) @ unit_rows(xa).T >= cosine, 1))
        ids = [r[0] for r in a]
        other = i, j
    else:
        xb, kb = np.array([r[1] for r in b]), np.array([r[2] for r in b])
        i, j = np.nonzero(unit_rows(xa) @ unit_rows(xb).T >= cosine)
        ids = [r[0] for r in a] + [r[0] for r in b]
        other = i, j + len(a)
    first = np.ones(len(i), bool)
    for at in range(0, len(i), 65536):  # bounded memory: keys are compared for so many pairs at once
        p, q = ka[i[at:at + 65536]], kb[j[at:at + 65536]]
        low = np.full(len(p), np.iinfo(np.int64).max)
        for c in range(p.shape[1]):
            hit = (q == p[:, c:c + 1]).any(axis=1)
            low = np.where(hit & (p[:, c] < low), p[:, c], low)
        first[at:at + 65536] = low == key
    i, j = other[0][first], other[1][first]
    copies = np.array([r[3] for r in a] + ([] if b is a else [r[3] for r in b]), np.int64)
    counts = np.zeros(len(ids), np.int64)
    np.add.at(counts, i, copies[j])
    np.add.at(counts, j, copies[i])
    parent, tree = np.arange(len(ids)), []
    for p, q in zip(i.tolist(), j.tolist(), strict=True):
        r, s = _find(parent, p), _find(parent, q)
        if r != s:
            parent[s] = r
            tree.append((ids[p], ids[q]))
    return [(ids[k], int(counts[k])) for k in np.flatnonzero(counts)], tree


def bucket_links(members: DataFrame, cosine: float = COSINE) -> DataFrame:
    """From (key, p, q, side, cid, embedding, keys, copies): rows (a, n, b): links counted for a (b null), or a tree edge a-b."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out = None, ([], []), []

        def finish() -> None:
            if group is None or not rows[0] or (group[1] != group[2] and not rows[1]):
                return
            counts, tree = _block_links(group[0], rows[0], None if group[1] == group[2] else rows[1], cosine)
            out.extend((c, n, None) for c, n in counts)
            out.extend((a, 0, b) for a, b in tree)

        def flushed() -> pa.RecordBatch:
            a, n, b = zip(*out, strict=True) if out else ((), (), ())
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(n, pa.int64()), pa.array(b, pa.int64())],
                                              names=["a", "n", "b"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("key", "p", "q", "side", "cid", "copies")]
            vec = [np.asarray(v.values.to_numpy(zero_copy_only=False)) for v in batch.column("embedding")]
            keys = [np.asarray(v.values.to_numpy(zero_copy_only=False)) for v in batch.column("keys")]
            for k, p, q, side, cid, copies, v, ks in zip(*cols, vec, keys, strict=True):
                if (k, p, q) != group:
                    finish()
                    group, rows = (k, p, q), ([], [])
                rows[side].append((cid, v, ks, copies))
            if len(out) > 10_000:
                yield flushed()
        finish()
        yield flushed()

    return members.mapInArrow(run, "a long, n long, b long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES,
                    block: int = BLOCK) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    classes = written(vector_classes(vectors), "classes")
    n, dim = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    keyed = written(bucket_rows(classes, polytopes_for(n or 0, dim or 2), tables, probes), "keys")
    # buckets of two or more, and each member's block by a hash of its id
    size = keyed.select(F.explode(F.array_distinct("keys")).alias("key")).groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    held = keyed.select("cid", F.explode(F.array_distinct("keys")).alias("key")).join(size, "key")
    blocks = F.ceil(F.col("m") / F.lit(block)).cast("int")
    held = held.withColumn("blocks", blocks).withColumn(
        "mine", F.when(F.col("blocks") == 1, 0).otherwise(F.pmod(F.xxhash64("cid"), F.col("blocks"))).cast("int"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("mine")).alias("p"), F.greatest(o, F.col("mine")).alias("q"))))
    held = held.withColumn("pair", pair).select(
        "key", "pair.p", "pair.q", F.when(F.col("mine") == F.col("pair.p"), 0).otherwise(1).alias("side"), "cid")
    full = classes.select("cid", "embedding", "copies").join(keyed, "cid")
    members = (held.join(full, "cid").select("key", "p", "q", "side", "cid", "embedding", "keys", "copies")
               .repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "side"))
    links = written(bucket_links(members, cosine), "links", few=True)
    tied = components(links.where("b is not null").select("a", "b"))
    counted = links.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    per_class = (classes.join(counted, "cid", "left").join(tied.withColumnRenamed("node", "cid"), "cid", "left")
                 .select("label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("component", "cid").alias("component_id")))
    v = vectors.select("vec_id", "label", F.transform(F.col("embedding").cast("array<double>"), lambda c: c + F.lit(0.0)).alias("embedding"))
    out = v.join(per_class, ["label", "embedding"], "left")
    comp = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      comp.cast("long").alias("component_id"), F.col("vec_id").eqNullSafe(comp).alias("kept"))
