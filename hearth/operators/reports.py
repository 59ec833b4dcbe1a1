"""Dashboard and SQL-report tables: KPIs, group means, summaries, vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TARGET

PROJECTED = ("id", "title", "monthly_rent_eur", "neighborhood", "rooms", "is_pet_friendly",
             "first_seen", "last_seen")


def read_projected(df: DataFrame) -> DataFrame:
    """The 8 listing columns, newest first_seen first (missing dates first, as DESC in SQL)."""
    return df.select(*PROJECTED).orderBy(F.desc_nulls_first("first_seen"))


def latest_first(df: DataFrame) -> DataFrame:
    """Sorted by last_seen descending, missing dates last (when the column exists)."""
    return df.orderBy(F.desc_nulls_last("last_seen")) if "last_seen" in df.columns else df


def kpi_summary(df: DataFrame) -> DataFrame:
    """Total listings and mean rent, raw and formatted with thousands separators."""
    return (df.agg(F.count(F.lit(1)).alias("total_listings"), F.avg(TARGET).alias("_avg"))
            .select("total_listings", F.round("_avg", 6).alias("avg_rent_eur"),
                    F.format_number(F.col("_avg"), 2).alias("avg_rent_display")))


def mean_by_category(df: DataFrame, col: str = "neighborhood") -> DataFrame:
    """Mean rent per category (NULL category dropped), highest first, ties by name."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.round(F.avg(TARGET), 6).alias("avg_rent_eur"))
            .orderBy(F.desc("avg_rent_eur"), F.asc(col)))


def category_summary(df: DataFrame, min_listings: int = 1) -> DataFrame:
    """COUNT, ROUND(AVG rent, 0), ROUND(AVG rooms, 1) per neighborhood, HAVING COUNT > n,
    ordered by the rounded mean rent descending (SQL GROUP BY keeps the NULL group)."""
    return (df.groupBy("neighborhood")
            .agg(F.count(F.lit(1)).alias("total_listings"),
                 F.round(F.avg(TARGET), 0).alias("avg_rent_eur"),
                 F.round(F.avg("rooms"), 1).alias("avg_rooms"))
            .where(F.col("total_listings") > min_listings)
            .orderBy(F.desc("avg_rent_eur"), F.asc("neighborhood")))


def distinct_categories(df: DataFrame, col: str = "neighborhood") -> DataFrame:
    """Distinct non-null values cast to string, without the text 'nan'."""
    v = F.col(col).cast("string")
    return df.where(F.col(col).isNotNull()).select(v.alias(col)).where(F.lower(col) != "nan").distinct()


def category_vocabulary(data: DataFrame, model_vocab: DataFrame, col: str = "neighborhood") -> DataFrame:
    """Sorted union of the data's categories and a fitted encoder's categories."""
    return (distinct_categories(data, col).unionByName(distinct_categories(model_vocab, col))
            .distinct().orderBy(col))
