"""Rent model: smoothed target encoding, boosted trees over histogram cells, random search, scoring.

The category is encoded by ``SmoothedTargetEncoder`` (fitted on training rows only; a table of categories, never a
driver-side list), pets become 0/1, and boosted trees are fitted for squared error (``operators.boosting``). Training
rows are first collapsed to distinct input vectors with their number and mean target, then to cells of input bins, whose
number has a fixed bound; the trees are fitted on the cells.

A fitted model is tables: categories, nodes of the trees, and the prediction of every combination of bins (the
*grid*). Scoring looks up the category and then the grid, two joins with small tables.

Random search samples parameter maps from the learning-rate × depth × trees grid with ``random.Random(seed)``. All
(map, fold) models are fitted at once; maps that differ only in the number of trees share a fit, because the first n
trees of a model are the model with n trees. Folds come from a hash of the listing id, so they do not depend on
partitioning; the encodings of all folds come from one aggregate, and the errors of all maps from one more.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import (CV_FOLDS, DEFAULT_MODEL, FEATURES, LEARNING_RATES, MAX_DEPTHS, N_ESTIMATORS,
                         SEARCH_ITERATIONS, SEED, TARGET)
from ..functions.hashing import split_bucket
from ..session import cut_lineage
from . import boosting
from .boosting import bin_of
from .encoding import SmoothedTargetEncoder, SmoothedTargetEncoderModel, smoothed

VECTOR_INPUTS = ("neighborhood_te", "rooms_f", "pets01")
BINS = ("neighborhood_bin", "rooms_bin", "pets_bin")


def training_frame(df: DataFrame) -> DataFrame:
    """Feature and target columns only (price_per_room is left out: it is derived from the target)."""
    return df.select("id", *FEATURES, TARGET).where(F.col(TARGET).isNotNull())


def _rooms() -> Column:
    return F.coalesce(F.col("rooms").cast("double"), F.lit(0.0))


def _pets() -> Column:
    return F.when(F.col("is_pet_friendly"), 1.0).otherwise(0.0)


def model_inputs(df: DataFrame, encoder: SmoothedTargetEncoderModel) -> DataFrame:
    """``df`` with the numeric model inputs (missing rooms count as 0)."""
    return encoder.transform(df, out="neighborhood_te").withColumns({"rooms_f": _rooms(), "pets01": _pets()})


def collapsed(df: DataFrame) -> DataFrame:
    """One row per distinct input vector: the inputs, the number of rows and their mean target."""
    return df.groupBy(*VECTOR_INPUTS).agg(F.count(F.lit(1)).cast("double").alias("weight"), F.avg(TARGET).alias(TARGET))


def _cells(vectors: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """(bins, rows, total) of collapsed vectors."""
    bins = [bin_of(F.col(x), cuts[x]).alias(b) for x, b in zip(VECTOR_INPUTS, BINS)]
    return (vectors.select(*bins, "weight", TARGET).groupBy(*BINS)
            .agg(F.sum("weight").alias("rows"), F.sum(F.col("weight") * F.col(TARGET)).alias("total")))


def _every_cell(spark: SparkSession, cuts: dict[str, list[float]]) -> DataFrame:
    """All combinations of bins (their number is bounded by the bins of each input)."""
    out = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(len(cuts[VECTOR_INPUTS[0]])))).alias(BINS[0]))
    for x, b in zip(VECTOR_INPUTS[1:], BINS[1:]):
        out = out.withColumn(b, F.explode(F.sequence(F.lit(0), F.lit(len(cuts[x])))))
    return out


@dataclass
class RentModel:
    """Category table and prior, cuts of the inputs, nodes of the trees, cells it was fitted on, grid of predictions."""
    encoder: SmoothedTargetEncoderModel
    cuts: dict[str, list[float]]
    trees: int
    max_depth: int
    nodes: DataFrame
    cells: DataFrame
    grid: DataFrame

    def bins(self, df: DataFrame) -> DataFrame:
        """``df`` with the bins of its rows; unseen and missing categories take the prior."""
        known = self.encoder.stats.select(F.col(self.encoder.col).alias("_cat"),
                                          bin_of(F.col("encoded"), self.cuts[VECTOR_INPUTS[0]]).alias("_bin"))
        at = df.join(known, F.col(self.encoder.col) == F.col("_cat"), "left")
        return at.select(*[df[c] for c in df.columns],
                         F.coalesce("_bin", bin_of(self.encoder.prior, self.cuts[VECTOR_INPUTS[0]])).alias(BINS[0]),
                         bin_of(_rooms(), self.cuts[VECTOR_INPUTS[1]]).alias(BINS[1]),
                         bin_of(_pets(), self.cuts[VECTOR_INPUTS[2]]).alias(BINS[2]))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``."""
        cols = [c for c in df.columns if c != "prediction"]
        return self.bins(df.select(*cols)).join(self.grid, list(BINS), "left").select(*cols, "prediction")

    def contributions(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` and ``phi_<feature>``: exact Shapley values against the training rows. They sum to
        the prediction minus the mean prediction of the training rows."""
        cols = [c for c in df.columns if c != "prediction"]
        phi = boosting.shapley(self.grid, self.cells, BINS)
        named = [F.col(f"phi_{b}").alias(f"phi_{f}") for b, f in zip(BINS, FEATURES)]
        return self.bins(df.select(*cols)).join(phi, list(BINS), "left").select(*cols, "prediction", *named)


def fit_encoder(train: DataFrame) -> SmoothedTargetEncoderModel:
    """The encoder with its category table written once (scoring does not fit it again)."""
    fitted = SmoothedTargetEncoder().fit(train)
    prior = train.select(F.avg(TARGET)).first()[0]
    return SmoothedTargetEncoderModel(cut_lineage(fitted.stats), F.lit(prior).cast("double"), fitted.col)


def fit_model(train: DataFrame, learning_rate: float = DEFAULT_MODEL[0], max_depth: int = DEFAULT_MODEL[1],
              n_estimators: int = DEFAULT_MODEL[2]) -> RentModel:
    """One fit with the given (by default the documented) parameters."""
    spark = train.sparkSession
    train = cut_lineage(training_frame(train))
    encoder = fit_encoder(train)
    vectors = cut_lineage(collapsed(model_inputs(train, encoder)))
    found = boosting.cut_points(vectors, VECTOR_INPUTS)
    cuts = {x: found.get((x,), []) for x in VECTOR_INPUTS}
    cells = cut_lineage(_cells(vectors, cuts))
    nodes = cut_lineage(boosting.fit_trees(cells, BINS, learning_rate, max_depth, n_estimators))
    grid = cut_lineage(boosting.fold_trees(_every_cell(spark, cuts), nodes, BINS, n_estimators, max_depth))
    return RentModel(encoder, cuts, n_estimators, max_depth, nodes, cells, grid)


def search_grid(n_iter: int = SEARCH_ITERATIONS, seed: int = SEED, learning_rates: Sequence[float] = LEARNING_RATES,
                max_depths: Sequence[int] = MAX_DEPTHS, n_estimators: Sequence[int] = N_ESTIMATORS) -> list[tuple]:
    """(learning rate, depth, trees) of the sampled parameter maps."""
    combos = list(itertools.product(learning_rates, max_depths, n_estimators))
    return random.Random(seed).sample(combos, min(n_iter, len(combos)))


def fold_vectors(data: DataFrame, folds: int) -> DataFrame:
    """(fold, part, category, rooms_f, pets01, neighborhood_te, weight, target mean): for every fold the distinct raw vectors
    of all parts, encoded by the rows outside the fold. ``part`` is the fold the rows themselves belong to."""
    raw = (data.withColumns({"rooms_f": _rooms(), "pets01": _pets()}).groupBy("part", FEATURES[0], "rooms_f", "pets01")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(TARGET).alias("s")))
    raw = cut_lineage(raw)
    outside = raw.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).where("fold <> part")
    prior = outside.groupBy("fold").agg((F.sum("s") / F.sum("n")).alias("prior"))
    stats = (outside.where(F.col(FEATURES[0]).isNotNull()).groupBy("fold", F.col(FEATURES[0]).alias("_cat"))
             .agg(F.sum("n").alias("n"), (F.sum("s") / F.sum("n")).alias("mean")).join(prior, "fold"))
    stats = stats.select("fold", "_cat", smoothed(F.col("n"), F.col("mean"), F.col("prior")).alias("_te"))
    every = raw.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).join(prior, "fold")
    stats = stats.withColumnRenamed("fold", "_fold")
    return (every.join(stats, (F.col("fold") == F.col("_fold")) & (F.col(FEATURES[0]) == F.col("_cat")), "left")
            .select("fold", "part", FEATURES[0], "rooms_f", "pets01", F.coalesce("_te", "prior").alias("neighborhood_te"),
                    F.col("n").cast("double").alias("weight"), "s"))


def cross_validate(train: DataFrame, n_iter: int = SEARCH_ITERATIONS, folds: int = CV_FOLDS, seed: int = SEED, **grid) -> DataFrame:
    """Mean MAE over the folds of every sampled map: learning_rate, max_depth, n_estimators, cv_mae, rank."""
    maps = search_grid(n_iter, seed, **grid)
    stages: dict[tuple[float, int], list[int]] = {}
    for lr, depth, n in maps:
        stages.setdefault((float(lr), int(depth)), []).append(int(n))
    data = cut_lineage(training_frame(train).withColumn("part", split_bucket(F.col("id"), seed + 1) % folds))
    vectors = cut_lineage(fold_vectors(data, folds))
    inside = F.col("fold") == F.col("part")
    found = boosting.cut_points(vectors.where(~inside), VECTOR_INPUTS, by=("fold",))
    bins = []
    for x, b in zip(VECTOR_INPUTS, BINS):
        of = F.lit(0)
        for k in range(folds):
            of = F.when(F.col("fold") == k, bin_of(F.col(x), found.get((k, x), []))).otherwise(of)
        bins.append(of.cast("int").alias(b))
    # cells met only in the fold itself have no rows to learn from, but are scored
    at = cut_lineage(vectors.select("fold", "part", FEATURES[0], "rooms_f", "pets01", *bins, "weight", "s"))
    cells = at.groupBy("fold", *BINS).agg(F.sum(F.when(~inside, F.col("weight")).otherwise(0.0)).alias("rows"),
                                          F.sum(F.when(~inside, F.col("s")).otherwise(0.0)).alias("total"))
    staged = boosting.staged_predictions(cells, BINS, list(stages), stages)
    number = {m: i for i, m in enumerate((float(lr), int(d), int(n)) for lr, d, n in maps)}
    index = F.lit(None).cast("int")
    for (lr, d, n), i in number.items():
        index = F.when((F.col("learning_rate") == lr) & (F.col("max_depth") == d) & (F.col("trees") == n), F.lit(i)).otherwise(index)
    # one column of predictions a map, so that a row of the fold is read once for all maps
    wide = staged.groupBy("fold", *BINS).agg(*[F.max(F.when(index == i, F.col("prediction"))).alias(f"p{i}") for i in range(len(maps))])
    scored = at.where(inside).join(wide, ["fold", *BINS]).select("fold", F.col(FEATURES[0]).alias("_cat"), "rooms_f", "pets01",
                                                                 *[f"p{i}" for i in range(len(maps))])
    rows = data.select(F.col("part").alias("_part"), F.col(FEATURES[0]).alias("_category"), _rooms().alias("_r"), _pets().alias("_p"), F.col(TARGET).alias("_y"))
    met = rows.join(scored, (F.col("_part") == F.col("fold")) & F.col("_category").eqNullSafe(F.col("_cat"))
                    & (F.col("_r") == F.col("rooms_f")) & (F.col("_p") == F.col("pets01")))
    per_fold = met.groupBy("fold").agg(*[F.avg(F.abs(F.col("_y") - F.col(f"p{i}"))).alias(f"p{i}") for i in range(len(maps))])
    mean = per_fold.agg(*[F.avg(f"p{i}").alias(f"p{i}") for i in range(len(maps))])
    out = mean.select(F.inline(F.array(*[F.struct(
        F.lit(float(lr)).alias("learning_rate"), F.lit(int(d)).alias("max_depth"), F.lit(int(n)).alias("n_estimators"),
        F.col(f"p{i}").alias("cv_mae")) for i, (lr, d, n) in enumerate(maps)])))
    order = Window.orderBy("cv_mae", "learning_rate", "max_depth", "n_estimators")  # one row a map
    return out.withColumn("rank", F.row_number().over(order))


def fit_search(train: DataFrame, **search) -> tuple[RentModel, DataFrame]:
    """The model refitted with the best sampled parameters, and the search results."""
    results = cut_lineage(cross_validate(train, **search))
    best = results.where("rank = 1").first()
    return fit_model(train, best["learning_rate"], best["max_depth"], best["n_estimators"]), results


def save_model(model: RentModel, path: str) -> str:
    spark = model.encoder.stats.sparkSession
    model.encoder.stats.write.mode("overwrite").parquet(f"{path}/categories")
    for name in ("nodes", "cells", "grid"):
        getattr(model, name).write.mode("overwrite").parquet(f"{path}/{name}")
    cuts = [F.lit([float(c) for c in model.cuts[x]]).cast("array<double>").alias(x) for x in VECTOR_INPUTS]
    (spark.range(1).select(model.encoder.prior.alias("prior"), F.lit(model.encoder.col).alias("col"), F.lit(model.trees).alias("trees"),
                           F.lit(model.max_depth).alias("max_depth"), *cuts).write.mode("overwrite").parquet(f"{path}/model"))
    return path


def load_model(path: str, spark: SparkSession | None = None) -> RentModel:
    spark = spark or SparkSession.active()
    one = spark.read.parquet(f"{path}/model").first()
    encoder = SmoothedTargetEncoderModel(spark.read.parquet(f"{path}/categories"), F.lit(one["prior"]).cast("double"), one["col"])
    return RentModel(encoder, {x: list(one[x]) for x in VECTOR_INPUTS}, one["trees"], one["max_depth"],
                     *(spark.read.parquet(f"{path}/{name}") for name in ("nodes", "cells", "grid")))


def predict(model: RentModel, df: DataFrame, out: str = "predicted_rent_eur") -> DataFrame:
    """Score a table; the prediction is rounded to 2 decimals."""
    return model.transform(df).select(*df.columns, F.round("prediction", 2).alias(out))


def model_vocabulary(model: RentModel) -> DataFrame:
    """Categories the fitted model knows, sorted; 'nan' text excluded."""
    return (model.encoder.vocabulary().where(F.lower(model.encoder.col) != "nan").distinct()
            .orderBy(model.encoder.col))


def feature_importance(model: RentModel) -> DataFrame:
    """Mean absolute Shapley value of each model input over the training rows, as shares in percent."""
    phi = boosting.shapley(model.grid, model.cells, BINS).join(model.cells.select(*BINS, "rows"), list(BINS))
    sums = phi.agg(*[F.sum(F.abs(F.col(f"phi_{b}")) * F.col("rows")).alias(b) for b in BINS])
    whole = sum((F.col(b) for b in BINS[1:]), F.col(BINS[0]))
    return sums.select(F.inline(F.array(*[F.struct(
        F.lit(f).alias("feature"), F.when(whole > 0, F.col(b) * 100.0 / whole).otherwise(0.0).alias("importance_percent"))
        for f, b in zip(FEATURES, BINS)])))
