"""Target encoders as DataFrame fit/transform pairs.

A fitted encoder is a small DataFrame of per-category statistics plus a
prior held as a scalar subquery; applying it is a left join on the
category. The join is not hinted: adaptive execution broadcasts the
statistics when their measured size is under the broadcast threshold and
otherwise keeps a shuffle join (whose skewed partitions it splits).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import TARGET, TE_MIN_SAMPLES_LEAF, TE_SMOOTHING


def mean_target_encode(df: DataFrame, col: str = "neighborhood", target: str = TARGET,
                       out: str | None = None) -> DataFrame:
    """Replace ``col`` by the mean target of its category; NULL/unseen → overall mean.

    Fitted and applied on the same rows (the export path); use
    ``SmoothedTargetEncoder`` on a train split for modelling.
    """
    out = out or col
    means = (df.where(F.col(col).isNotNull()).groupBy(col)
             .agg(F.avg(target).alias("_enc")))
    overall = df.select(F.avg(target)).scalar()
    enc = F.coalesce(F.col("_enc"), overall)
    joined = df.join(means, col, "left")
    cols = [enc.alias(out) if c == out else F.col(c) for c in df.columns]
    if out not in df.columns:
        cols.append(enc.alias(out))
    return joined.select(*cols)


def smoothed(n: Column, mean: Column, prior: Column, min_samples_leaf: int = TE_MIN_SAMPLES_LEAF,
             smoothing: float = TE_SMOOTHING) -> Column:
    """Sigmoid-smoothed encoding of a category seen ``n`` times; one seen once takes the prior."""
    w = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(min_samples_leaf)) / F.lit(smoothing)))
    return F.when(n == 1, prior).otherwise(prior * (F.lit(1.0) - w) + mean * w)


@dataclass
class SmoothedTargetEncoderModel:
    stats: DataFrame          # (category, n, mean, encoded)
    prior: Column             # scalar subquery: mean target of the training rows
    col: str

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        out = out or f"{self.col}_te"
        s = self.stats.select(F.col(self.col).alias("_cat"), F.col("encoded").alias("_enc"))
        j = df.join(s, df[self.col] == s["_cat"], "left")
        return j.select(*[df[c] for c in df.columns], F.coalesce(F.col("_enc"), self.prior).alias(out))

    def vocabulary(self) -> DataFrame:
        return self.stats.select(self.col)


@dataclass
class SmoothedTargetEncoder:
    """Sigmoid-smoothed target encoding.

    weight(n) = 1 / (1 + exp(-(n - min_samples_leaf) / smoothing))
    encoded   = prior * (1 - weight) + mean * weight; a category seen once
    gets the prior, as do NULL and unseen categories. ``method="m_estimate"``
    uses n / (n + m) with ``m = smoothing`` instead.
    """
    col: str = "neighborhood"
    target: str = TARGET
    min_samples_leaf: int = TE_MIN_SAMPLES_LEAF
    smoothing: float = TE_SMOOTHING
    method: str = "sigmoid"

    def fit(self, train: DataFrame) -> SmoothedTargetEncoderModel:
        prior = train.select(F.avg(self.target)).scalar()
        st = (train.where(F.col(self.col).isNotNull()).groupBy(self.col)
              .agg(F.count(F.col(self.target)).alias("n"), F.avg(self.target).alias("mean")))
        n = F.col("n")
        if self.method == "sigmoid":
            enc = smoothed(n, F.col("mean"), prior, self.min_samples_leaf, self.smoothing)
        elif self.method == "m_estimate":
            w = n / (n + F.lit(self.smoothing))
            enc = prior * (F.lit(1.0) - w) + F.col("mean") * w
        else:
            raise ValueError(self.method)
        return SmoothedTargetEncoderModel(st.withColumn("encoded", enc), prior, self.col)
