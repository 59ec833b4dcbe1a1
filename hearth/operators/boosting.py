"""Boosted regression trees over histogram cells.

Inputs are cut into at most ``MAX_BINS`` bins each. For squared error a boosted model depends on the rows only
through the number of rows and the sum of their targets in every combination of bins (a *cell*), because all
rows of a cell have the same prediction in every round. Spark reduces the table to its cells once (one
aggregate, combined before the shuffle); from there on the size has a bound that does not depend on the data, and
every model is one group. All models of a search are fitted side by side, one group each.

A model starts from the mean target. Each tree is grown level by level: one histogram keyed by (node, input,
bin) gives the sums of every possible split; a node takes the split of the largest gain
``GL²/(HL+λ) + GR²/(HR+λ) - G²/(H+λ)`` (ties: the earlier input, then the lower cut), if it exceeds ``LEAST_GAIN`` and both
sides hold at least one row; a leaf adds ``learning rate * G / (H + λ)``, with G the sum of residuals and H the rows.

A fitted model is a table of nodes: (tree, node, input, cut, left, right, value, gain, rows). ``fold_trees`` scores
with it by joins: a row walks one level of all trees with each join.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

MAX_BINS = 256
LAMBDA = 1.0
LEAST_GAIN = 1e-6

NODES = "tree int, node int, input int, cut int, left int, right int, value double, gain double, rows double"


def bin_of(x: Column, cuts: Sequence[float]) -> Column:
    """Number of cuts below ``x``: bin k holds the values in (cut k-1, cut k]."""
    if not cuts:
        return F.when(x.isNotNull(), F.lit(0))
    return F.size(F.filter(F.lit([float(c) for c in cuts]), lambda c: c < x))


def cut_points(rows: DataFrame, inputs: Sequence[str], weight: str = "weight", by: Sequence[str] = (),
               max_bins: int = MAX_BINS) -> dict[tuple, list[float]]:
    """(*by, input) -> cuts. Up to ``max_bins`` distinct values: the midpoints between neighbours. More: values at
    equal steps of the rows, so that every bin holds about the same number of rows."""
    long = rows.select(*by, weight, F.explode(F.array(*[F.struct(F.lit(c).alias("input"), F.col(c).alias("x")) for c in inputs])).alias("_e"))
    key = [*by, "input"]
    marks = (long.select(*by, "_e.input", "_e.x", weight).where("x is not null").groupBy(*key, "x")
             .agg(F.sum(weight).cast("long").alias("n")))
    marks = cut_lineage(marks)
    counted = marks.groupBy(*key).agg(F.count(F.lit(1)).alias("_d"))
    # a feature of few values: one row with at most max_bins of them
    small = marks.join(counted.where(F.col("_d") <= max_bins), key).groupBy(*key).agg(F.sort_array(F.collect_list("x")).alias("values"))
    found = {}
    for r in small.collect():
        v = r["values"]
        found[tuple(r[k] for k in key)] = [(a + b) / 2 for a, b in zip(v, v[1:])]
    large = counted.where(F.col("_d") > max_bins).select(*key)
    if not large.isEmpty():
        for r in _weighted_steps(marks.join(large, key), key, max_bins).collect():
            found[tuple(r[k] for k in key)] = sorted(set(r["cuts"]))[:max_bins - 1]
    return found


def _weighted_steps(marks: DataFrame, key: Sequence[str], max_bins: int) -> DataFrame:
    """Per key the values at equal steps of the running number of rows; the running sum is taken within ranges of
    values whose totals are summed first, so no task holds all distinct values of an input."""
    grid = marks.groupBy(*key).agg(F.percentile_approx("x", [i / 64 for i in range(1, 64)], 1000).alias("_g"), F.sum("n").alias("_all"))
    part = marks.join(grid, list(key)).withColumn("_r", F.expr("size(filter(_g, g -> g < x))"))
    totals = part.groupBy(*key, "_r").agg(F.sum("n").alias("_t"))
    before = Window.partitionBy(*key).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    run = Window.partitionBy(*key, "_r").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = part.join(totals, [*key, "_r"]).withColumn("_end", F.col("_before") + F.sum("n").over(run))
    step = F.col("_all") / F.lit(max_bins)
    crosses = F.floor(F.col("_end") / step) > F.floor((F.col("_end") - F.col("n")) / step)
    return at.where(crosses & (F.col("_end") < F.col("_all"))).groupBy(*key).agg(F.collect_list("x").alias("cuts"))


def boost(bins: np.ndarray, rows: np.ndarray, total: np.ndarray, learning_rate: float, max_depth: int, trees: int,
          each: Callable[[int, np.ndarray], None] | None = None, lam: float = LAMBDA) -> tuple[float, list[tuple]]:
    """(base, nodes) of one model over cells: ``bins`` (cells x inputs), their ``rows`` and the ``total`` of their targets.

    Cells without rows are scored too but do not count. ``each(n, predictions)`` is called after every tree.
    """
    width = bins.max(axis=0) + 1 if len(bins) else np.ones(bins.shape[1], np.int64)
    base = float(total.sum() / rows.sum())
    pred, nodes = np.full(len(bins), base), []
    for t in range(trees):
        g = total - rows * pred
        place = np.zeros(len(bins), np.int64)  # node of each cell, numbered as in a complete tree from 0
        at, value = {0: len(nodes)}, np.zeros((1 << (max_depth + 1)) - 1)
        nodes.append(None)
        open_ = np.arange(len(bins))
        for level in range(max_depth + 1):
            low, many = (1 << level) - 1, 1 << level
            own = place[open_] - low
            sums, held = (np.bincount(own, x[open_], many) for x in (g, rows))
            live = np.unique(own)
            best = np.full(many, -1.0), np.zeros(many, np.int64), np.zeros(many, np.int64)
            if level < max_depth:
                parent = sums ** 2 / (held + lam)
                for f in range(bins.shape[1]):
                    key = own * width[f] + bins[open_, f]
                    gl, hl = (np.bincount(key, x[open_], many * width[f]).reshape(many, width[f]).cumsum(axis=1)[:, :-1] for x in (g, rows))
                    if not gl.shape[1]:
                        continue
                    gr, hr = sums[:, None] - gl, held[:, None] - hl
                    gain = gl ** 2 / (hl + lam) + gr ** 2 / (hr + lam) - parent[:, None]
                    gain[(hl < 1) | (hr < 1)] = -1.0
                    cut = gain.argmax(axis=1)
                    top = gain[np.arange(many), cut]
                    more = top > best[0] + LEAST_GAIN * np.maximum(1.0, np.abs(best[0])) if f else top > best[0]
                    for x, y in zip(best, (top, np.full(many, f), cut)):
                        x[more] = y[more]
            split = np.zeros(many, bool)
            for k in live.tolist():
                if best[0][k] > LEAST_GAIN * max(1.0, sums[k] ** 2 / (held[k] + lam)):
                    split[k] = True
                    left = 2 * (low + k) + 1
                    at[left], at[left + 1] = len(nodes), len(nodes) + 1
                    nodes += [None, None]
                    nodes[at[low + k]] = (t, low + k, int(best[1][k]), int(best[2][k]), left, left + 1, None, float(best[0][k]), float(held[k]))
                else:
                    value[low + k] = learning_rate * sums[k] / (held[k] + lam)
                    nodes[at[low + k]] = (t, low + k, None, None, None, None, float(value[low + k]), None, float(held[k]))
            go = split[own]
            open_, own = open_[go], own[go]
            if not len(open_):
                break
            right = bins[open_, best[1][own]] > best[2][own]
            place[open_] = 2 * (low + own) + 1 + right
        pred = pred + value[place]
        if each is not None:
            each(t + 1, pred)
    return base, nodes


def _cells(group: pd.DataFrame, inputs: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    group = group.sort_values(list(inputs))
    return (group[list(inputs)].to_numpy(np.int64), group["rows"].to_numpy(float), group["total"].to_numpy(float))


def fit_trees(cells: DataFrame, inputs: Sequence[str], learning_rate: float, max_depth: int, trees: int) -> DataFrame:
    """Nodes of one model from (inputs as bins, rows, total); tree -1 holds the base value."""
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        base, nodes = boost(*_cells(group, inputs), learning_rate, max_depth, trees)
        first = (-1, 0, None, None, None, None, base, None, float(group["rows"].sum()))
        out = pd.DataFrame([first, *nodes], columns=[c.split()[0] for c in NODES.split(", ")])
        return out.astype({c: "Int32" for c in ("input", "cut", "left", "right")})

    return cells.groupBy(F.lit(0).alias("model")).applyInPandas(fit, NODES)


def staged_predictions(cells: DataFrame, inputs: Sequence[str], models: Sequence[tuple[float, int]], stages: dict[tuple[float, int], list[int]],
                       by: str = "fold") -> DataFrame:
    """(by, learning_rate, max_depth, trees, inputs, prediction): every model fitted on every group of ``by``, its
    predictions in all cells after each number of trees that is asked for. One Spark group per (model, ``by``)."""
    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        fold, lr, depth = key
        bins, rows, total = _cells(group, inputs)
        parts = []

        def keep(n: int, pred: np.ndarray) -> None:
            if n in stages[lr, depth]:
                parts.append(pd.DataFrame({by: fold, "learning_rate": lr, "max_depth": depth, "trees": n,
                                           **{c: bins[:, i] for i, c in enumerate(inputs)}, "prediction": pred}))

        if rows.sum() > 0:
            boost(bins, rows, total, lr, depth, max(stages[lr, depth]), keep)
        return pd.concat(parts) if parts else pd.DataFrame(columns=[by, "learning_rate", "max_depth", "trees", *inputs, "prediction"])

    every = F.explode(F.array(*[F.struct(F.lit(float(lr)).alias("learning_rate"), F.lit(int(d)).alias("max_depth")) for lr, d in models]))
    schema = f"{by} int, learning_rate double, max_depth int, trees int, {', '.join(f'{c} int' for c in inputs)}, prediction double"
    # as many tasks as there are groups: AQE would put these few bytes into one
    n = 4 * len(models)
    spread = cells.withColumn("_m", every).select("*", "_m.*").drop("_m").repartition(n, by, "learning_rate", "max_depth")
    return spread.groupBy(by, "learning_rate", "max_depth").applyInPandas(fit, schema)


def fold_trees(rows: DataFrame, nodes: DataFrame, inputs: Sequence[str], trees: int, max_depth: int) -> DataFrame:
    """``rows`` (distinct, inputs as bins) with ``prediction``: each row walks all trees, one join a level."""
    n = nodes.where("tree >= 0").select("tree", "node", "input", "cut", "left", "right", "value")
    at = rows.select(*inputs).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("node", F.lit(0))
    at = at.join(n, ["tree", "node"])
    for _ in range(max_depth):
        x = F.array(*[F.col(c) for c in inputs])[F.col("input")]
        step = F.when(F.col("input").isNull(), F.col("node")).when(x <= F.col("cut"), F.col("left")).otherwise(F.col("right"))
        at = at.select(*inputs, "tree", step.alias("node")).join(n, ["tree", "node"])
    base = nodes.where("tree = -1").select("value").scalar()
    total = at.groupBy(*inputs).agg(F.sum("value").alias("_sum"))
    return rows.join(total, list(inputs), "left").withColumn("prediction", base + F.coalesce("_sum", F.lit(0.0))).drop("_sum")


def shapley(grid: DataFrame, cells: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """``grid`` (every combination of bins with ``prediction``) with one column ``phi_<input>`` per input: exact Shapley
    values against the rows of ``cells``; they sum to the prediction minus its mean over those rows.

    The value of a coalition S at x is the mean prediction when the inputs of S are those of x and the others are
    drawn jointly from the rows. Each coalition is one join of the grid with the others' weights and one aggregate.
    """
    k = len(inputs)
    out, all_rows = grid, cells.select(F.sum("rows")).scalar()
    names = {}
    for size in range(k):
        for s in itertools.combinations(inputs, size):
            rest = [c for c in inputs if c not in s]
            w = cells.groupBy(*rest).agg((F.sum("rows") / all_rows).alias("_w"))
            v = grid.join(w, rest).groupBy(*s).agg(F.sum(F.col("prediction") * F.col("_w")).alias("_v"))
            names[s] = f"_v{len(names)}"
            if s:
                out = out.join(v.withColumnRenamed("_v", names[s]), list(s))
            else:
                out = out.withColumn(names[s], v.select("_v").scalar())
    names[tuple(inputs)] = "prediction"
    phis = []
    for c in inputs:
        others = [x for x in inputs if x != c]
        phi = F.lit(0.0)
        for size in range(k):
            share = math.factorial(size) * math.factorial(k - size - 1) / math.factorial(k)
            for s in itertools.combinations(others, size):
                joined = tuple(x for x in inputs if x in s or x == c)
                phi = phi + F.lit(share) * (F.col(names[joined]) - F.col(names[s]))
        phis.append(phi.alias(f"phi_{c}"))
    return out.select(*grid.columns, *phis)
