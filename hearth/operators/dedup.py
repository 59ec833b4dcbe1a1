"""Keep the latest observation per listing key.

The winner per key is the row with the greatest
``(last_seen IS NULL, last_seen, tie-breakers...)``: a missing ``last_seen``
counts as the most recent (the original sorts missing dates last and keeps the
last row), equal dates go to the highest tie-breaker (``id``). Without a
``last_seen`` column the last row in input order (highest ``id``) is kept.

It is written as ``groupBy(key).agg(max_by(row, ordering))`` rather than a
``row_number`` window: the aggregate combines map-side, so a key holding a
third of all rows is reduced to one row per input partition before the
shuffle, while a window would sort that whole key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import LISTING_KEY


def recency_order(df: DataFrame, time_col: str = "last_seen",
                  tie_cols: Sequence[str] = ("id",)):
    fields = []
    if time_col in df.columns:
        fields += [F.col(time_col).isNull().alias("_t_missing"), F.col(time_col).alias("_t")]
    fields += [F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie_cols) if c in df.columns]
    if not fields:
        raise ValueError("keep_latest needs a time column or a tie-breaker column")
    return F.struct(*fields)


def keep_latest(df: DataFrame, key: Sequence[str] = LISTING_KEY, time_col: str = "last_seen",
                tie_cols: Sequence[str] = ("id",)) -> DataFrame:
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(*key)
              .agg(F.max_by(row, recency_order(df, time_col, tie_cols)).alias("_row"))
              .select("_row.*"))


def keep_latest_window(df: DataFrame, key: Sequence[str] = LISTING_KEY,
                       time_col: str = "last_seen", tie_cols: Sequence[str] = ("id",)) -> DataFrame:
    """Same result with ``row_number``; kept for comparison and small inputs."""
    from pyspark.sql import Window
    order = []
    if time_col in df.columns:
        order.append(F.col(time_col).desc_nulls_first())
    order += [F.col(c).desc() for c in tie_cols if c in df.columns]
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
