"""Regression metrics as aggregates (one pass, map-side combined)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TARGET


def _metric_aggs(label: str, pred: str):
    y, p = F.col(label), F.col(pred)
    e = p - y
    return [F.count(F.lit(1)).alias("n"),
            F.avg(F.abs(e)).alias("_mae"),
            F.avg(e * e).alias("_mse"),
            F.sum(e * e).alias("_sse"),
            F.var_pop(y).alias("_vy"),
            F.avg(F.when(y != 0, F.abs(e / y))).alias("_ape")]


def _finish(df: DataFrame, keys: Sequence[str], scale: int) -> DataFrame:
    # total sum of squares = n · population variance (a numerically stable aggregate)
    sst = F.col("_vy") * F.col("n")
    r2 = F.when(sst > 0, F.lit(1.0) - F.col("_sse") / sst)
    return df.select(*keys, "n", F.round("_mae", scale).alias("mae"),
                     F.round(F.sqrt("_mse"), scale).alias("rmse"),
                     F.round(r2, scale).alias("r2"),
                     F.round(F.col("_ape") * 100.0, scale).alias("mape"))


def regression_metrics(df: DataFrame, label: str = TARGET, pred: str = "prediction",
                       scale: int = 6) -> DataFrame:
    """n, MAE, RMSE, R² and MAPE (over non-zero labels) in one aggregate."""
    return _finish(df.agg(*_metric_aggs(label, pred)), [], scale)


def metrics_by_group(df: DataFrame, group: str = "neighborhood", label: str = TARGET,
                     pred: str = "prediction", scale: int = 6) -> DataFrame:
    return _finish(df.groupBy(group).agg(*_metric_aggs(label, pred)), [group], scale)
