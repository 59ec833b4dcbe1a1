"""Exact quantiles with pandas' default (linear interpolation) semantics.

``bracketed``: selection by brackets, for any number of rows. One scan makes a mergeable sketch (KLL) of every
wanted column and takes from it, for each wanted rank, a bracket of two values that holds the rank but for the sketch's
error. A second scan counts the values below each bracket and the distinct values inside; the rank is found
among the latter. All columns and probabilities share both scans, and only bracket ends and results reach the driver. A
bracket that would hold more than ``INSIDE`` rows is sketched again first (one more scan for a table about 1 / (2 ``EPS``)
times as long); one that missed its rank (a sketch's error has no certain bound) is noticed by its counts and widened.
``exact``: Spark's ``percentile`` over value counts, one query; its state holds all distinct values of a column.
``approx``: ``percentile_approx`` with fixed-size sketches.
``auto`` (the default): ``exact`` for tables of at most ``INSIDE`` rows, which bounds its state, else ``bracketed``.
The results of the three exact methods are the same.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST = sys.float_info.max
SKETCH_K = 4096
EPS = 0.003  # of a rank, more than twice the error of a sketch of that size
INSIDE = 1_000_000  # rows of a bracket that are ranked in one task, about


@dataclass
class Bracket:
    """Where the ranks of one (column, probability) lie: values from ``lo`` to ``hi`` (None: no bound)."""
    column: str
    prob: float
    lo: float | None = None
    hi: float | None = None
    rows: int | None = None  # expected inside
    eps: float = EPS

    def value(self) -> Column:
        return F.col(self.column).cast("double")

    def holds(self, x: Column) -> Column:
        inside = x.isNotNull() & ~F.isnan(x)
        if self.lo is not None:
            inside = inside & (x >= self.lo)
        return inside & (x <= self.hi) if self.hi is not None else inside

    def below(self, x: Column) -> Column:
        return x < self.lo if self.lo is not None else F.lit(False)


def _narrowed(df: DataFrame, brackets: list[Bracket]) -> list[Bracket | float | None]:
    """Every bracket cut to what a sketch of its values leaves, or its quantile where that is known already; one scan, with one sketch for each range of a column."""
    ranges = list(dict.fromkeys((b.column, b.lo, b.hi) for b in brackets))
    aggs = []
    for i, key in enumerate(ranges):
        b = Bracket(key[0], 0.0, key[1], key[2])
        x = b.value()
        aggs += [F.count(x).alias(f"all{i}"), F.count_if(b.below(x)).alias(f"below{i}"), F.count_if(b.holds(x)).alias(f"n{i}"),
                 # a sketch takes finite values only
                 F.kll_sketch_agg_double(F.when(b.holds(x), F.greatest(F.lit(-MOST), F.least(F.lit(MOST), x))), F.lit(SKETCH_K)).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    out, asked = [], []
    for b in brackets:
        i = ranges.index((b.column, b.lo, b.hi))
        n, below, inside = (row[f"{c}{i}"] for c in ("all", "below", "n"))
        at = (n - 1) * b.prob - below
        first, last = math.floor(at), math.ceil(at)
        if 0 <= first and last < inside:
            asked.append((len(out), i, max(0.0, first / inside - b.eps), min(1.0, (last + 1) / inside + b.eps)))
            out.append(Bracket(b.column, b.prob, None, None, int(2 * b.eps * inside), b.eps))
        elif b.lo is None:  # no values, or the higher rank is a NaN's: the quantile is known
            out.append(None if n == 0 else math.nan)
        else:
            out.append(Bracket(b.column, b.prob, eps=min(0.5, 8 * b.eps)))
    if asked:
        ends = df.sparkSession.range(1).select(*[F.kll_sketch_get_quantile_double(F.lit(row[f"s{i}"]), F.lit([lo, hi])).alias(f"q{k}")
                                                 for k, i, lo, hi in asked]).first()
        for k, _, _, _ in asked:
            lo, hi = ends[f"q{k}"]
            out[k].lo, out[k].hi = -math.inf if lo <= -MOST else lo, math.inf if hi >= MOST else hi
    return out


def _selected(df: DataFrame, brackets: list[Bracket]) -> dict[int, float | None]:
    """The quantile of every bracket that holds its ranks: one scan, reduced to distinct values before the shuffle."""
    parts = []
    for i, b in enumerate(brackets):
        x = b.value()
        item = F.struct(F.lit(i).alias("b"), F.when(b.holds(x), x).alias("v"), F.when(b.holds(x) | b.below(x), 0).otherwise(1).alias("over"))
        parts.append(F.when(x.isNotNull(), item))
    long = df.select(F.explode(F.filter(F.array(*parts), lambda e: e.isNotNull())).alias("e")).select("e.*")
    counts = long.groupBy("b", "over", "v").agg(F.count(F.lit(1)).alias("n"))
    total = Window.partitionBy("b")
    run = total.orderBy("over", F.col("v").asc_nulls_first())  # below the bracket, inside, beyond
    at = counts.withColumn("end", F.sum("n").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn(
        "all", F.sum("n").over(total))
    prob = F.element_at(F.lit([float(b.prob) for b in brackets]), F.col("b") + 1)
    pos = (F.col("all") - 1) * prob
    hit = [F.max(F.when((F.col("end") - F.col("n") <= r) & (r < F.col("end")), F.struct("v"))) for r in (F.floor(pos), F.ceil(pos))]
    out: dict[int, float | None] = {}
    for r in at.groupBy("b").agg(F.max(pos).alias("pos"), hit[0].alias("lo"), hit[1].alias("hi")).collect():
        lo, hi = r["lo"], r["hi"]
        if lo["v"] is None or hi["v"] is None:
            continue
        ends = [lo["v"], hi["v"]]
        low, high = float(int(r["pos"])), float(-int(-r["pos"] // 1))
        # the same interpolation form as Spark's percentile
        out[r["b"]] = ends[0] if low == high else (high - r["pos"]) * ends[0] + (r["pos"] - low) * ends[1]
    return out


def bracketed_quantiles(df: DataFrame, wanted: dict[str, Sequence[float]], inside: int = INSIDE) -> dict[str, list[float | None]]:
    """column -> quantiles at its probabilities (None for a column without values); two scans for all of them."""
    open_ = {(c, k): Bracket(c, float(p)) for c, probs in wanted.items() for k, p in enumerate(probs)}
    found: dict[tuple[str, int], float | None] = {}
    while open_:
        keys = list(open_)
        ready = [k for k in keys if open_[k].rows is not None and open_[k].rows <= inside]
        if len(ready) < len(keys):
            more = [k for k in keys if k not in ready]
            for k, b in zip(more, _narrowed(df, [open_[k] for k in more])):
                if isinstance(b, Bracket):
                    open_[k] = b
                else:
                    found[k] = b
                    del open_[k]
            continue
        got = _selected(df, [open_[k] for k in keys])
        for i, k in enumerate(keys):
            if i in got:
                found[k] = got[i]
            else:  # the bracket missed: a wider one
                open_[k] = Bracket(k[0], open_[k].prob, eps=min(0.5, 8 * open_[k].eps))
        open_ = {k: b for k, b in open_.items() if k not in found}
    return {c: [found[c, k] for k in range(len(probs))] for c, probs in wanted.items()}


def method_for(df: DataFrame) -> str:
    """``exact`` where the number of rows bounds its state, else ``bracketed``."""
    return "exact" if df.count() <= INSIDE else "bracketed"


def quantiles(df: DataFrame, col: str, probs: Sequence[float], method: str = "auto",
              accuracy: int = 100000) -> DataFrame:
    """One row with an array column ``q`` holding the requested quantiles."""
    return column_quantiles(df, [col], probs, method, accuracy).select("q")


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], method: str = "auto",
                     accuracy: int = 100000) -> DataFrame:
    """(column_name, q): the quantiles of several columns at once (q null for a column without values)."""
    p = F.array(*[F.lit(float(x)) for x in probs])
    if method == "auto":
        method = method_for(df)
    if method == "bracketed":
        found = bracketed_quantiles(df, {c: probs for c in cols})
        rows = [(c, None if q and q[0] is None else q) for c, q in found.items()]
        return df.sparkSession.createDataFrame(rows, "column_name string, q array<double>")
    if method == "approx":
        aggs = [F.struct(F.lit(c).alias("column_name"), F.percentile_approx(F.col(c).cast("double"), p, accuracy).alias("q")) for c in cols]
        return df.agg(F.array(*aggs).alias("_a")).select(F.inline("_a"))
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")
    if len(cols) == 1:
        v = F.col(cols[0]).cast("double")
        counts = df.where(v.isNotNull()).groupBy(v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        return counts.agg(F.percentile(F.col("_v"), p, F.col("_n")).alias("q")).select(F.lit(cols[0]).alias("column_name"), "q")
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_v")) for c in cols])
    long = df.select(F.explode(items).alias("_x")).select("_x.*")
    counts = long.groupBy("column_name", "_v").agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy("column_name").agg(F.percentile(F.col("_v"), p, F.col("_n")).alias("q"))


def iqr_stats(df: DataFrame, col: str, factor: float = 1.5, method: str = "auto") -> DataFrame:
    """One row: q1, q3, iqr, lower, upper (Tukey fences over non-null values)."""
    q = quantiles(df, col, (0.25, 0.75), method)
    q1, q3 = F.col("q")[0], F.col("q")[1]
    return q.select(q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"),
                    (q1 - F.lit(factor) * (q3 - q1)).alias("lower"),
                    (q3 + F.lit(factor) * (q3 - q1)).alias("upper"))


def fences(df: DataFrame, col: str, factor: float = 1.5, method: str = "auto") -> tuple[Column, Column]:
    """Lower and upper fences: literals that reach the scan as pushed filters where the method computes them at once,
    else scalar subqueries (computed once, merged by Catalyst)."""
    if method == "auto":
        method = method_for(df)
    if method == "bracketed":
        q1, q3 = bracketed_quantiles(df, {col: (0.25, 0.75)})[col]
        if q1 is None:
            return F.lit(None).cast("double"), F.lit(None).cast("double")
        return F.lit(q1 - factor * (q3 - q1)), F.lit(q3 + factor * (q3 - q1))
    s = iqr_stats(df, col, factor, method)
    return s.select("lower").scalar(), s.select("upper").scalar()
