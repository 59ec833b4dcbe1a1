"""Feature engineering: price per room, category encoding, binary encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TARGET
from ..functions.numeric import binary01, safe_ratio
from .encoding import mean_target_encode


def price_per_room(df: DataFrame) -> DataFrame:
    if TARGET in df.columns and "rooms" in df.columns:
        return df.withColumn("price_per_room", safe_ratio(F.col(TARGET), F.col("rooms")))
    return df


def binary_encode(df: DataFrame, col: str = "is_pet_friendly") -> DataFrame:
    if col not in df.columns:
        return df
    return df.withColumn(col, binary01(F.col(col), df.schema[col].dataType))


def engineer_features(df: DataFrame) -> DataFrame:
    """Order matters: the ratio uses raw values, then the category, then the flag is encoded."""
    out = price_per_room(df)
    if "neighborhood" in out.columns and TARGET in out.columns:
        out = mean_target_encode(out, "neighborhood", TARGET)
    return binary_encode(out)
