"""Constraint checks as row splits (rows are tagged, never silently lost)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import LISTING_KEY, PRICE_WINDOW, TARGET

NOT_NULL = ("title", TARGET, "neighborhood")


def null_violations(df: DataFrame, cols: Sequence[str] = NOT_NULL) -> DataFrame:
    """Rows breaking NOT NULL, with the offending columns listed."""
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.withColumn("violations", missing).where(F.col("violations") != "")


def not_null_rows(df: DataFrame, cols: Sequence[str] = NOT_NULL) -> DataFrame:
    return df.dropna(subset=[c for c in cols if c in df.columns])


def key_violations(df: DataFrame, key: Sequence[str] = LISTING_KEY) -> DataFrame:
    """Keys occurring more than once (the uniqueness constraint)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def within_price_window(df: DataFrame, window: tuple[float, float] = PRICE_WINDOW) -> DataFrame:
    return df.where(F.col(TARGET).between(*window))


def validate_requests(req: DataFrame) -> DataFrame:
    """Scoring requests: neighborhood and rooms required, rooms >= 1, pets default False.

    Adds ``reject_reason`` (NULL when valid) and fills the pets default.
    """
    reason = (F.when(F.col("neighborhood").isNull(), F.lit("neighborhood: field required"))
              .when(F.col("rooms").isNull(), F.lit("rooms: field required"))
              .when(F.col("rooms") < 1, F.lit("rooms: must be >= 1")))
    return (req.withColumn("is_pet_friendly", F.coalesce(F.col("is_pet_friendly"), F.lit(False)))
               .withColumn("reject_reason", reason))
