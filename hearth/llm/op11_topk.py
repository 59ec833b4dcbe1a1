"""Exact top-k search by inner product over an M-tree.

Vectors become integers, ``floor(256 * x)``; the score of two vectors is their inner product. With one more coordinate,
``sqrt(M - |x|^2)`` for an indexed vector (M: the largest squared length) and 0 for a query, the squared Euclidean
distance is ``|q|^2 + M - 2 q.x``, so the highest scores are the nearest points of a metric space.

The index has three levels. The root routes every vector to its nearest routing object: a region with a covering radius.
A region is cut into shelves by a hash, so that a crowded one is many groups; a shelf is loaded by one task into pages of
at most ``PAGE`` vectors around routing objects of its own. A page row is a metric node: center, covering radius,
distance to the parent's routing object, and its vectors with their distances to the center.

A search takes regions best first, by the lower bound "distance minus radius", in rounds of 1, 3, 12, ... regions; after
each round the k-th score of a query shuts out all regions that cannot beat it. Within a shelf pages are taken best
first; the stored parent distances shut out pages, and then vectors, before their distance is computed. Bounds carry a slack
that exceeds the rounding of double precision, and scores are exact integers, so nothing is lost. A (region, shelf) with
many queries is searched by several tasks.

The routing objects are a bounded sample: at most ``REGIONS`` vectors of least hash, for any number of rows. Equal vectors
are one entry with its ``top + 1`` smallest ids; a larger id among equal ones can be in no answer.

Defined results: null vectors, vectors with null or non-finite components and rows without an id take no part. Rows that
share an id count as one: a pair's score is the best over their vectors. Vectors of different lengths compare by their
common components (missing ones are 0), an empty vector scores 0. Scaled components saturate at ``LIMIT``. Fewer than
``top`` others: all of them. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free, written

SCALE = 256
TOP = 5
EVERY = 50  # queries: rows whose id it divides
LIMIT = (1 << 27) - 1
REGIONS = 1024  # routing objects of the root, at most
REGION_ROWS = 2048  # vectors aimed at in a region while there are fewer regions than that
SHELF = 8192  # vectors of a shelf, about
PAGE = 128  # vectors of a page, at most
QUERIES = 2048  # queries that a task holds against one shelf, about
SLACK = 1e-6  # of the largest distance

_KEY = ["region", "shelf", "part"]


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """Distinct (vec_id, x) of the vectors that take part."""
    e = F.col("embedding").cast("array<double>")
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e"))
    fine = F.col("vec_id").isNotNull() & F.col("e").isNotNull() & F.forall(
        "e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform("e", lambda c: F.floor(F.greatest(F.lit(float(-LIMIT)), F.least(F.lit(float(LIMIT)), c * scale))).cast("long"))
    return v.where(fine).select("vec_id", x.alias("x")).distinct()


def vector_classes(v: DataFrame, top: int = TOP) -> DataFrame:
    """(x, ids): each distinct vector with its ``top + 1`` smallest ids."""
    near = v.withColumn("_at", F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))).where(F.col("_at") <= top + 1)
    return near.groupBy("x").agg(F.collect_list("vec_id").alias("ids"))


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of an array of lists, filled up with zeros to ``dim``."""
    n = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (n == dim).all():
        return flat.reshape(len(n), dim).astype(np.int64)
    out = np.zeros((len(n), dim), np.int64)
    out[np.arange(dim)[None, :] < n[:, None]] = flat
    return out


class Space:
    """The metric: Euclidean, over vectors with one more coordinate."""

    def __init__(self, most: float, dim: int):
        self.most, self.dim = most, dim

    def norms(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(float)
        return np.einsum("...i,...i->...", x, x)

    def between(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Distances of indexed vectors (rows of x) from indexed vectors (rows of y)."""
        a, b = (np.sqrt(np.maximum(0.0, self.most - self.norms(v))) for v in (x, y))
        return np.sqrt(np.maximum(0.0, 2 * (self.most - x.astype(float) @ y.T.astype(float) - a[:, None] * b[None, :])))

    def from_query(self, q: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Distances of a query from indexed vectors (rows of y)."""
        return np.sqrt(np.maximum(0.0, float(self.norms(q)) + self.most - 2 * (y.astype(float) @ q.astype(float))))

    def of_score(self, q: np.ndarray, score: int | None) -> float:
        """The distance at which a query has that score."""
        return math.inf if score is None else math.sqrt(max(0.0, float(self.norms(q)) + self.most - 2.0 * score))

    def slack(self, q: np.ndarray) -> float:
        return SLACK * math.sqrt(float(self.norms(q)) + self.most)


def place(classes: DataFrame, centers: np.ndarray, space: Space) -> DataFrame:
    """(region, distance, x, ids): every class under its nearest routing object."""
    known = classes.sparkSession.sparkContext.broadcast(centers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                c = b.slice(at, 1024)
                d = space.between(_matrix(c.column("x"), space.dim), known.value)
                best = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best.astype(np.int32)), pa.array(d[np.arange(len(best)), best]), c.column("x"), c.column("ids")],
                    names=["region", "distance", "x", "ids"])

    return classes.select("x", "ids").mapInArrow(run, "region int, distance double, x array<long>, ids array<long>")


def load_pages(x: np.ndarray, ids: list[list[int]], parent: np.ndarray, space: Space, page: int = PAGE) -> list[dict]:
    """Metric nodes of one shelf: every vector under its nearest center; a crowded node is cut into rings."""
    wanted = math.ceil(2 * len(x) / page)
    centers = x[np.linspace(0, len(x) - 1, wanted).astype(int)]
    d = space.between(x, centers)
    own = d.argmin(axis=1)
    to_parent = space.between(centers, parent[None, :])[:, 0]
    out = []
    for c in range(wanted):
        members = np.flatnonzero(own == c)
        members = members[np.argsort(d[members, c], kind="stable")]
        for at in range(0, len(members), page):
            m = members[at:at + page]
            out.append({"center": centers[c].tolist(), "radius": float(d[m, c].max()), "to_parent": float(to_parent[c]),
                        "x": x[m].ravel().tolist(), "distance": d[m, c].tolist(),
                        "ids": [i for k in m for i in ids[k]], "copies": [len(ids[k]) for k in m]})
    return out


_PAGE = ("region int, shelf int, center array<long>, radius double, to_parent double, x array<long>, distance array<double>, "
         "ids array<long>, copies array<int>")


def page_rows(placed: DataFrame, centers: np.ndarray, space: Space, page: int = PAGE) -> DataFrame:
    """Pages from (region, shelf, x, ids)."""
    known = placed.sparkSession.sparkContext.broadcast(centers)
    schema = pa.schema([("region", pa.int32()), ("shelf", pa.int32()), ("center", pa.list_(pa.int64())), ("radius", pa.float64()),
                        ("to_parent", pa.float64()), ("x", pa.list_(pa.int64())), ("distance", pa.list_(pa.float64())),
                        ("ids", pa.list_(pa.int64())), ("copies", pa.list_(pa.int32()))])

    def load(key: tuple, rows: pa.Table) -> pa.Table:
        region, shelf = (k.as_py() for k in key)
        x = _matrix(rows.column("x").combine_chunks(), space.dim)
        order = np.lexsort(x.T[::-1]) if space.dim else np.arange(len(x))  # the same pages whatever the rows' order
        ids = rows.column("ids").to_pylist()
        made = load_pages(x[order], [ids[i] for i in order], known.value[region], space, page)
        return pa.Table.from_pylist([{"region": region, "shelf": shelf, **p} for p in made], schema=schema)

    return placed.select("region", "shelf", "x", "ids").groupBy("region", "shelf").applyInArrow(load, _PAGE)


class Shelf:
    """The pages of a shelf, ready for search."""

    def __init__(self, pages: pa.Table, space: Space):
        def parts(name: str) -> list[np.ndarray]:
            c = pages.column(name).combine_chunks()
            return np.split(c.flatten().to_numpy(zero_copy_only=False), c.offsets.to_numpy()[1:-1] - c.offsets.to_numpy()[0])

        self.space = space
        self.center = _matrix(pages.column("center").combine_chunks(), space.dim)
        self.radius, self.to_parent = pages.column("radius").to_numpy(), pages.column("to_parent").to_numpy()
        self.x = [p.reshape(-1, space.dim) if space.dim else np.zeros((len(d), 0), np.int64)
                  for p, d in zip(parts("x"), parts("distance"), strict=True)]
        self.distance, self.ids, self.copies = parts("distance"), parts("ids"), parts("copies")
        self.start = [np.cumsum(c) - c for c in self.copies]
        self.computed = 0  # distances and scores computed so far

    def search(self, q: np.ndarray, own: int, to_parent: float, least: int | None, top: int) -> list[tuple[int, int]]:
        """(-score, id) of the ``top`` best vectors that are not below score ``least``; ``own`` is left out."""
        space, slack, best = self.space, self.space.slack(q), []
        reach = space.of_score(q, least) + slack
        near = np.flatnonzero(np.abs(to_parent - self.to_parent) - self.radius <= reach)
        if not len(near):
            return best
        d = space.from_query(q, self.center[near])
        self.computed += len(near)
        bound = d - self.radius[near]
        for k in np.argsort(bound, kind="stable"):
            if bound[k] > reach:
                break
            p = near[k]
            open_ = np.flatnonzero(np.abs(d[k] - self.distance[p]) <= reach)
            self.computed += len(open_)
            score = self.x[p][open_] @ q
            if least is not None:
                open_, score = open_[score >= least], score[score >= least]
            if not len(open_):
                continue
            met = dict((i, s) for s, i in best)
            for e, s in zip(open_.tolist(), score.tolist(), strict=True):
                at = self.start[p][e]
                for i in self.ids[p][at:at + self.copies[p][e]].tolist():
                    if i != own and -s < met.get(i, 1 << 63):
                        met[i] = -s
            best = sorted((s, i) for i, s in met.items())[:top]
            if len(best) == top:
                least = max(-best[-1][0], least) if least is not None else -best[-1][0]
                reach = space.of_score(q, least) + slack
        return best


def next_regions(queries: DataFrame, centers: np.ndarray, radius: np.ndarray, space: Space, lo: int, hi: int) -> DataFrame:
    """(query_id, q, least, region, to_parent): of each query's regions, ordered best first, numbers lo to hi that may still hold an answer."""
    known = queries.sparkSession.sparkContext.broadcast((centers, radius))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers, radius = known.value
        for b in batches:
            for at in range(0, b.num_rows, 256):
                c = b.slice(at, 256)
                qs, least = _matrix(c.column("q"), space.dim), c.column("least").to_pylist()
                own, region, dist = [], [], []
                for i, q in enumerate(qs):
                    d = space.from_query(q, centers)
                    bound = np.maximum(0.0, d - radius)
                    order = np.lexsort((d, bound))[lo:hi]
                    order = order[bound[order] <= space.of_score(q, least[i]) + space.slack(q)]
                    own.append(np.full(len(order), i))
                    region.append(order)
                    dist.append(d[order])
                row = pa.array(np.concatenate(own))
                yield pa.RecordBatch.from_arrays(
                    [c.column("query_id").take(row), c.column("q").take(row), c.column("least").take(row),
                     pa.array(np.concatenate(region).astype(np.int32)), pa.array(np.concatenate(dist))],
                    names=["query_id", "q", "least", "region", "to_parent"])

    return queries.select("query_id", "q", "least").mapInArrow(
        run, "query_id long, q array<long>, least long, region int, to_parent double")


def searched(pages: DataFrame, asked: DataFrame, space: Space, top: int = TOP) -> DataFrame:
    """(query_id, vec_id, score): each query's best in each shelf it asks; both sides have region, shelf, part."""
    def search(key: tuple, pages: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if pages.num_rows and asked.num_rows:
            shelf = Shelf(pages, space)
            qs = _matrix(asked.column("q").combine_chunks(), space.dim)
            for q, own, d, least in zip(qs, *(asked.column(c).to_pylist() for c in ("query_id", "to_parent", "least")), strict=True):
                found.extend((own, i, -s) for s, i in shelf.search(q, own, d, least, top))
        cols = zip(*found, strict=True) if found else ((), (), ())
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    return pages.groupBy(*_KEY).cogroup(asked.groupBy(*_KEY)).applyInArrow(search, "query_id long, vec_id long, score long")


def _best(found: DataFrame, top: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def exact_top_k(vectors: DataFrame, top: int = TOP, every: int = EVERY, page: int = PAGE, shelf: int = SHELF,
                region_rows: int = REGION_ROWS) -> DataFrame:
    """Per query (row whose vec_id ``every`` divides): query_id, rank, vec_id, score of its ``top`` highest scores."""
    spark = vectors.sparkSession
    v = written(integer_vectors(vectors), "vectors")
    classes = written(vector_classes(v, top), "classes")
    x = F.col("x")
    size = F.aggregate(x, F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    n, most, dim = classes.agg(F.count("*"), F.max(size), F.max(F.size(x))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    space = Space(float(most), int(dim))
    count = min(REGIONS, math.ceil(n / region_rows))
    rows = [r["x"] for r in classes.orderBy(F.xxhash64("x"), "x").select("x").limit(count).collect()]
    centers = np.array([r + [0] * (dim - len(r)) for r in rows], np.int64).reshape(len(rows), dim)

    placed = written(place(classes, centers, space), "placed")
    free(classes)
    known = {r["region"]: r for r in placed.groupBy("region").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}
    radius = np.array([known[r]["radius"] if r in known else -math.inf for r in range(len(rows))])
    shelves = spark.createDataFrame([(r, math.ceil(k["n"] / shelf)) for r, k in known.items()], "region int, shelves int")
    cut = placed.join(F.broadcast(shelves), "region").withColumn(
        "shelf", F.pmod(F.xxhash64("x"), F.col("shelves").cast("long")).cast("int"))
    pages = written(page_rows(cut, centers, space, page), "pages")
    free(placed)

    best: DataFrame | None = None
    lo, hi = 0, 1
    while lo < len(rows):
        queries = v.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), x.alias("q"))
        if best is None:
            queries = queries.withColumn("least", F.lit(None).cast("long"))
        else:
            full = best.groupBy("query_id").agg(F.count("*").alias("k"), F.min("score").alias("least")).where(F.col("k") == top)
            queries = queries.join(full.drop("k"), "query_id", "left")
        asked = written(next_regions(queries, centers, radius, space, lo, hi), "asked")
        asks = asked.groupBy("region").agg(F.count("*").alias("asks")).collect()
        if asks:
            # at most REGIONS rows: how many tasks share the queries of each of a region's shelves
            parts = F.broadcast(spark.createDataFrame([(r["region"], math.ceil(r["asks"] / QUERIES)) for r in asks], "region int, parts int"))
            part = F.pmod(F.xxhash64("query_id"), F.col("parts").cast("long")).cast("int")
            at = asked.join(parts, "region").join(F.broadcast(shelves), "region").select(
                "query_id", "q", "least", "region", "to_parent", part.alias("part"),
                F.explode(F.sequence(F.lit(0), F.col("shelves") - 1)).alias("shelf"))
            held = pages.join(parts, "region").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
            found = searched(held, at, space, top)
            if best is not None:
                found = found.unionByName(best.select("query_id", "vec_id", "score"))
            before, best = best, written(_best(found, top), "best", few=True)
            free(before)
        free(asked)
        lo, hi = hi, hi + 3 * hi
    free(v, pages)
    return empty if best is None else best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
