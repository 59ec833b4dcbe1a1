"""Distinct counts that can be merged: sketches per day, stored and united.

``distinct_sketches`` reduces a table to one HyperLogLog sketch for each day and column in a single aggregate, whose
state is bounded by the sketch size. ``store_sketches`` keeps them as a table of days, where a day written again replaces its
own sketches only; ``distinct_estimates`` unites the sketches of any days without reading the rows again. Exact
counts (``profiling.category_profile``) stay the default of the profile.

Values count by their text; nulls do not count. Rows without a day form a part of their own. A column without
values has the estimate 0; no sketches give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14  # 2^14 registers: at most 16 KB a sketch
ERROR = 1.04 / 2 ** (LG_K / 2)  # relative standard error of united sketches
SIGMAS = 3


def distinct_sketches(df: DataFrame, columns: Sequence[str], day) -> DataFrame:
    """(day, column_name, sketch): one scan and one partial aggregate for all columns."""
    sketched = df.groupBy(day.cast("date").alias("day")).agg(
        *[F.hll_sketch_agg(F.col(c).cast("string"), LG_K).alias(f"_s{i}") for i, c in enumerate(columns)])
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return sketched.select("day", F.inline(items))


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Add days to a stored table of sketches; days already there are replaced, other days stay."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """(column_name, days, estimate) over all days of ``sketches``; filter them first for fewer days."""
    return sketches.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("days"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def compare_with_exact(estimates: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, days, exact, within_error): whether an estimate is within ``SIGMAS`` standard errors of the exact count."""
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    exact = (df.select(F.inline(values)).where(F.col("value").isNotNull()).distinct()
             .groupBy("column_name").agg(F.count(F.lit(1)).alias("exact")))
    both = estimates.join(exact, "column_name", "left").withColumn("exact", F.coalesce("exact", F.lit(0)))
    off = F.abs(F.col("estimate") - F.col("exact"))
    return both.select("column_name", "days", "exact", (off <= F.ceil(SIGMAS * ERROR * F.col("exact"))).alias("within_error"))
