"""Ranked lexical search with pipelined term partitioning.

Items are short queries, documents are ranked for each by an integer form of BM25. Terms are owned by ``STAGES``
stages, rarest terms first. Bundles of items visit one stage after the other: at each, a cogroup brings a bundle's
accumulators (item, document, score so far) together with the postings that the stage's terms have there, and adds their
integer contributions. After the last stage the best are selected.

Documents are cut into shards of ``SHARD`` by position, and a bundle holds ``BUNDLE`` items, so a cogroup's group has a
fixed bound, however frequent a term is: its postings are spread over all shards. Accumulators are sparse and carried
only while they matter: a document is dropped when its score and all that later stages could add stay below a score that
``top`` documents have reached already (in its shard, or anywhere in an earlier stage). What is dropped can be in
no answer.

Documents are read once; their postings (only of the items' terms) are written as one row per document. What is sent to
all tasks is bounded: items are taken in slices of about ``SLICE_TERMS`` terms, each with its own scan.

Defined results: a text's terms are maximal runs of ASCII letters and digits and all non-ASCII characters, A-Z lower-cased;
null has none. Rows of documents count each, also repeated ones; a document without an id counts in the statistics and is
in no answer. Identical rows of items count once, several texts under one item id are one item with the terms of all, items
without an id are left out. An item whose terms occur nowhere has no rows. Empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free, written

TOP = 10
STAGES = (0.1, 0.25, 0.5, 1.0)  # share of all postings that the stages up to each one own
SHARD = 2048  # documents of a shard
BUNDLE = 256  # items of a bundle
SLICE_TERMS = 200_000  # (item, term) pairs of a slice, about
SLICE_ITEMS = 4096  # items of a slice, about

# separators become blanks, A-Z small letters; bytes from 0x80 on stay
_FOLD = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in zip(b.column("item_id").to_pylist(), b.column("text"), strict=True):
                terms, times = np.unique(np.array(terms_of(t.as_py() or b""), object), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(terms), pa.int64()), pa.array(terms.tolist(), pa.binary()), pa.array(times, pa.int64())],
                    names=["item_id", "term", "times"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    return (rows.where("item_id is not null").distinct().mapInArrow(run, "item_id long, term binary, times long")
            .groupBy("item_id", "term").agg(F.sum("times").alias("times")))


def postings(docs: DataFrame, vocabulary: dict[bytes, int], shard: int = SHARD) -> DataFrame:
    """(shard, place, doc_id, n, terms, tf) per document; shards are runs of ``shard`` documents of one task."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, at, task = known.value.get, 0, TaskContext.get().partitionId()
        for b in batches:
            sizes, ends, terms, tf = [], [0], [], []
            for t in b.column("text"):
                words = terms_of(t.as_py() or b"")
                sizes.append(len(words))
                u, c = np.unique(np.array([k for k in map(get, words) if k is not None], np.int32), return_counts=True)
                terms.append(u)
                tf.append(c)
                ends.append(ends[-1] + len(u))
            place = np.arange(at, at + len(sizes))
            at += len(sizes)
            offsets = pa.array(ends, pa.int32())
            flat = np.concatenate(terms) if terms else np.zeros(0, np.int32)
            times = np.concatenate(tf) if tf else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((task << 32) + place // shard, pa.int64()), pa.array((place % shard).astype(np.int32)), b.column("doc_id"),
                 pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))],
                names=["shard", "place", "doc_id", "n", "terms", "tf"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "shard long, place int, doc_id long, n long, terms array<int>, tf array<long>")


class Corpus:
    """Documents with a term, and all their terms."""

    def __init__(self, documents: int, terms: int):
        self.documents, self.terms = documents, terms

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 75 + (75 * n * self.documents) // self.terms
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))


def _flat(b: pa.RecordBatch, corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, impact) of every posting of a batch."""
    lists, tf = b.column("terms"), b.column("tf").flatten().to_numpy()
    row = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
    return row, lists.flatten().to_numpy(), corpus.impact(tf, b.column("n").to_numpy()[row])


def term_statistics(posted: DataFrame, corpus: Corpus, terms: int) -> DataFrame:
    """(term, df, best): documents that hold a term, and its largest impact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, best = np.zeros(terms, np.int64), np.zeros(terms, np.int64)
        for b in batches:
            _, term, impact = _flat(b, corpus)
            df += np.bincount(term, minlength=terms)
            np.maximum.at(best, term, impact)
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(df[met]), pa.array(best[met])], names=["term", "df", "best"])

    return (posted.select("n", "terms", "tf").mapInArrow(run, "term int, df long, best long")
            .groupBy("term").agg(F.sum("df").alias("df"), F.max("best").alias("best")))


class Plan:
    """Who owns which term: stages of the terms, and for each bundle its items' terms with their multipliers."""

    def __init__(self, pairs: list[tuple[int, int, int]], items: list[int], stats: dict[int, tuple[int, int]], corpus: Corpus, terms: int,
                 bundle: int = BUNDLE, shard: int = SHARD):
        self.items, self.stages, self.bundle, self.shard = items, len(STAGES), bundle, shard
        self.stage = np.full(terms, -1, np.int8)
        order = sorted(stats, key=lambda t: (stats[t][0], t))
        upto = np.cumsum([stats[t][0] for t in order]) if order else np.zeros(0)
        for t, c in zip(order, upto.tolist(), strict=True):
            self.stage[t] = next(i for i, share in enumerate(STAGES) if c <= share * upto[-1])
        self.bundles = math.ceil(len(items) / bundle)
        # of each bundle: term -> (items by their number in the bundle, multipliers)
        self.owners: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []
        self.rest = np.zeros((self.stages, len(items)), np.int64)  # what the stages after one can add to an item's document
        lists: list[dict[int, list[tuple[int, int]]]] = [{} for _ in range(self.bundles)]
        for item, term, times in pairs:
            if term in stats:
                more = times * corpus.weight(stats[term][0])
                lists[item // bundle].setdefault(term, []).append((item % bundle, more))
                self.rest[:self.stage[term], item] += more * stats[term][1]
        for held in lists:
            self.owners.append({t: (np.array([i for i, _ in x]), np.array([m for _, m in x], np.int64)) for t, x in held.items()})
        self.floor = np.zeros(len(items), np.int64)  # a score that ``top`` documents have reached

    def items_of(self, bundle: int) -> list[int]:
        return self.items[bundle * self.bundle:(bundle + 1) * self.bundle]


_POSTED = "bundle int, shard long, place array<int>, doc array<long>, term array<int>, impact array<long>"


def stage_postings(posted: DataFrame, plan, corpus: Corpus, stage: int) -> DataFrame:
    """Postings of one stage's terms, a row for each (bundle, shard) of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        mine = p.stage == stage
        member = [np.isin(np.arange(len(mine)), list(o)) & mine for o in p.owners]
        for b in batches:
            row, term, impact = _flat(b, corpus)
            here = b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)[row] & mine[term]
            row, term, impact = row[here], term[here], impact[here]
            shard, place = b.column("shard").to_numpy(), b.column("place").to_numpy()
            doc = b.column("doc_id").fill_null(0).to_numpy()
            out = []
            for s in np.unique(shard[row]).tolist():
                at = shard[row] == s
                for k, m in enumerate(member):
                    use = np.flatnonzero(at & m[term]) if len(member) > 1 else np.flatnonzero(at)
                    if len(use):
                        out.append((k, s, place[row[use]], doc[row[use]], term[use], impact[use]))
            cols = list(zip(*out, strict=True)) if out else [()] * 6
            types = (pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)],
                                             names=["bundle", "shard", "place", "doc", "term", "impact"])

    return posted.select("shard", "place", "doc_id", "n", "terms", "tf").mapInArrow(run, _POSTED)


_CARRIED = "bundle int, shard long, item int, kth long, place array<int>, doc array<long>, score array<long>"
_FOUND = "item_id long, doc_id long, score long"


def visit(carried: DataFrame, brought: DataFrame, plan, stage: int, top: int) -> DataFrame:
    """One stage: bundles' accumulators meet the postings. Accumulators again, or after the last stage the best of each shard."""
    def meet(key: tuple, carried: pa.Table, brought: pa.Table) -> pa.Table:
        p: Plan = plan.value
        bundle, shard = (k.as_py() for k in key)
        items, owners = p.items_of(bundle), p.owners[bundle]
        last = stage == p.stages - 1
        acc, doc = np.zeros((len(items), p.shard), np.int64), np.zeros(p.shard, np.int64)

        def column(t: pa.Table, name: str) -> np.ndarray:
            return t.column(name).combine_chunks().flatten().to_numpy()

        if carried.num_rows:
            lengths = np.diff(carried.column("place").combine_chunks().offsets.to_numpy())
            place = column(carried, "place")
            acc[np.repeat(carried.column("item").to_numpy(), lengths), place] = column(carried, "score")
            doc[place] = column(carried, "doc")
        if brought.num_rows:
            place, term, impact = (column(brought, c) for c in ("place", "term", "impact"))
            doc[place] = column(brought, "doc")
            order = np.argsort(term, kind="stable")
            cuts = np.flatnonzero(np.diff(term[order])) + 1
            for at in np.split(order, cuts):
                who, more = owners[int(term[at[0]])]
                acc[who[:, None], place[at][None, :]] += more[:, None] * impact[at][None, :]
        out = []
        for k in range(len(items)):
            alive = np.flatnonzero(acc[k])
            score = acc[k][alive]
            kth = int(np.partition(score, -top)[-top]) if len(score) >= top else 0
            at = bundle * p.bundle + k
            floor, rest = max(kth, int(p.floor[at])), int(p.rest[stage][at])
            use = score + rest >= floor
            alive, score = alive[use], score[use]
            if not len(alive):
                continue
            if last:
                best = np.lexsort((doc[alive], -score))[:top]
                out.extend((items[k], int(doc[alive[b]]), int(score[b])) for b in best)
            else:
                out.append((bundle, shard, k, kth, alive.astype(np.int32), doc[alive], score))
        if last:
            cols = list(zip(*out, strict=True)) if out else [()] * 3
            return pa.Table.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=["item_id", "doc_id", "score"])
        cols = list(zip(*out, strict=True)) if out else [()] * 7
        types = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)],
                                    names=["bundle", "shard", "item", "kth", "place", "doc", "score"])

    schema = _FOUND if stage == len(STAGES) - 1 else _CARRIED
    return carried.groupBy("bundle", "shard").cogroup(brought.groupBy("bundle", "shard")).applyInArrow(meet, schema)


def _slice(docs: DataFrame, pairs: DataFrame, top: int, bundle: int, shard: int) -> DataFrame | None:
    """(item_id, doc_id, score): each shard's best for the items of one slice."""
    spark = docs.sparkSession
    rows = pairs.collect()  # one slice
    if not rows:
        return None
    items = sorted({r["item_id"] for r in rows})
    number = {i: k for k, i in enumerate(items)}
    vocabulary: dict[bytes, int] = {}
    held = [(number[r["item_id"]], vocabulary.setdefault(bytes(r["term"]), len(vocabulary)), r["times"])
            for r in sorted(rows, key=lambda r: (r["item_id"], bytes(r["term"])))]
    posted = written(postings(docs, vocabulary, shard), "postings")
    n, total = posted.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    if not n:
        free(posted)
        return None
    corpus = Corpus(n, total)
    stats = {r["term"]: (r["df"], r["best"]) for r in term_statistics(posted, corpus, len(vocabulary)).collect()}
    plan = Plan(held, items, stats, corpus, len(vocabulary), bundle, shard)
    carried, before = spark.createDataFrame([], _CARRIED), None
    for stage in range(len(STAGES)):
        known = spark.sparkContext.broadcast(plan)
        carried = written(visit(carried, stage_postings(posted, known, corpus, stage), known, stage, top), "bundles")
        free(before)
        before = carried
        if stage < len(STAGES) - 1:
            for r in carried.groupBy("bundle", "item").agg(F.max("kth").alias("kth")).collect():
                at = r["bundle"] * bundle + r["item"]
                plan.floor[at] = max(plan.floor[at], r["kth"])
    free(posted)
    return carried


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, slice_terms: int = SLICE_TERMS,
                  bundle: int = BUNDLE, shard: int = SHARD) -> DataFrame:
    """Per item: item_id, rank, doc_id, score of its ``top`` highest-scoring documents with a score above 0."""
    pairs = written(item_terms(items), "items", few=True)
    n, many = pairs.agg(F.count("*"), F.countDistinct("item_id")).first()
    slices = max(1, math.ceil(n / slice_terms), math.ceil(many / SLICE_ITEMS))
    found = None
    for k in range(slices):
        one = _slice(docs, pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == k), top, bundle, shard)
        if one is not None:
            found = one if found is None else found.unionByName(one)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
