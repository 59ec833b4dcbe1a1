"""Data-quality profile of a listing table.

Each profile is one lazy query. Per-column statistics are computed in one
scan by unpivoting the profiled columns to (column, value) rows; the only
broadcast is the per-column bounds table, whose size is the number of
profiled columns (a static list).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (IQR_FACTOR, LISTING_KEY, NULL_FLAG_PERCENT, NULL_PROFILE_COLUMNS,
                         OUTLIER_SAMPLE, PRICE_WINDOW, TARGET, TOP_CATEGORIES)
from ..session import cut_lineage
from .quantiles import column_quantiles

NUMERIC_PROFILE_COLUMNS = ("rooms", "monthly_rent_eur")


def _pct(part, whole, scale=2):
    return F.when(whole > 0, F.round(part * 100.0 / whole, scale)).otherwise(F.lit(0.0))


def schema_profile(df: DataFrame) -> DataFrame:
    """(position, column, dtype, non_null, null_count, null_percent) for every column."""
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(c)).alias(f"_nn{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"),
                              F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                              F.col(f"_nn{i}").alias("non_null"))
                     for i, c in enumerate(cols)])
    return (counts.select("_rows", F.inline(rows))
            .select("position", "column_name", "dtype", "non_null",
                    (F.col("_rows") - F.col("non_null")).alias("null_count"),
                    _pct(F.col("_rows") - F.col("non_null"), F.col("_rows")).alias("null_percent")))


def null_distribution(df: DataFrame, cols: Sequence[str] = NULL_PROFILE_COLUMNS,
                      flag_percent: float = NULL_FLAG_PERCENT) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    p = schema_profile(df.select(*present))
    return p.select("column_name", "null_count", "null_percent",
                    F.col("non_null").alias("non_null_count"),
                    (F.col("null_percent") > flag_percent).alias("flagged"))


def _long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric columns to (column, value[, keep...]) rows, NULL values dropped."""
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
                      for c in cols])
    return (df.select(*keep, F.explode(items).alias("_x"))
              .select(F.col("_x.column_name").alias("column_name"), F.col("_x.value").alias("value"), *keep)
              .where(F.col("value").isNotNull()))


def numeric_profile(df: DataFrame, cols: Sequence[str] = NUMERIC_PROFILE_COLUMNS,
                    method: str = "auto") -> DataFrame:
    """count, mean, median, std (sample), min, max, q1, q3, iqr over non-null values.

    ``method`` as in ``operators.quantiles``.
    """
    cols = [c for c in cols if c in df.columns]
    long = _long(df, cols)
    moments = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    quant = column_quantiles(df, cols, (0.25, 0.5, 0.75), method).withColumnRenamed("q", "_q")
    return (moments.join(quant, "column_name")
            .select("column_name", "count", "mean", F.col("_q")[1].alias("median"), "std", "min", "max",
                    F.col("_q")[0].alias("q1"), F.col("_q")[2].alias("q3"),
                    (F.col("_q")[2] - F.col("_q")[0]).alias("iqr")))


def outlier_bounds(df: DataFrame, cols: Sequence[str] = NUMERIC_PROFILE_COLUMNS, factor: float = IQR_FACTOR,
                   method: str = "auto") -> DataFrame:
    """(column_name, lower_bound, upper_bound): Tukey fences of every column with values."""
    q = column_quantiles(df, [c for c in cols if c in df.columns], (0.25, 0.75), method).where("q is not null")
    q1, q3 = F.col("q")[0], F.col("q")[1]
    return q.select("column_name", (q1 - factor * (q3 - q1)).alias("lower_bound"), (q3 + factor * (q3 - q1)).alias("upper_bound"))


def anomaly_profile(df: DataFrame, cols: Sequence[str] = NUMERIC_PROFILE_COLUMNS, factor: float = IQR_FACTOR,
                    method: str = "auto", bounds: DataFrame | None = None) -> DataFrame:
    """Per column: fences, outlier count and share of all rows (NULL rows in the denominator). ``bounds``: the fences,
    where ``outlier_bounds`` has computed them already."""
    cols = [c for c in cols if c in df.columns]
    b = outlier_bounds(df, cols, factor, method) if bounds is None else bounds
    # NULL values stay, so that one scan counts both the outliers and the rows
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in cols])
    long = df.select(F.explode(items).alias("_x")).select("_x.*").join(F.broadcast(b), "column_name")
    out = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    counts = long.groupBy("column_name").agg(F.first("lower_bound").alias("lower_bound"), F.first("upper_bound").alias("upper_bound"),
                                             F.count_if(out).alias("outlier_count"), F.count(F.lit(1)).alias("_rows"))
    return counts.select("column_name", "lower_bound", "upper_bound", "outlier_count",
                         _pct(F.col("outlier_count"), F.col("_rows")).alias("outlier_percent"))


def outlier_values(df: DataFrame, cols: Sequence[str] = NUMERIC_PROFILE_COLUMNS, order_col: str = "id",
                   factor: float = IQR_FACTOR, method: str = "auto", bounds: DataFrame | None = None) -> DataFrame:
    """Every outlier value: (column_name, id, value)."""
    cols = [c for c in cols if c in df.columns]
    b = outlier_bounds(df, cols, factor, method) if bounds is None else bounds
    long = _long(df, cols, keep=(order_col,)).join(F.broadcast(b), "column_name")
    out = long.where((F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound")))
    return out.select("column_name", F.col(order_col).alias("id"), "value")


def outlier_samples(df: DataFrame, cols: Sequence[str] = NUMERIC_PROFILE_COLUMNS,
                    n: int = OUTLIER_SAMPLE, order_col: str = "id",
                    factor: float = IQR_FACTOR, method: str = "auto", bounds: DataFrame | None = None) -> DataFrame:
    """The first ``n`` outlier values per column in row order: (column, position, id, value).

    ``row_number() <= n`` is planned as a window group limit, so each input
    partition forwards at most ``n`` rows per column to the final window.
    """
    out = outlier_values(df, cols, order_col, factor, method, bounds)
    w = Window.partitionBy("column_name").orderBy("id")
    return (out.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)
            .select("column_name", "position", "id", "value"))


def category_profile(df: DataFrame, col: str = "neighborhood") -> DataFrame:
    """Value counts of a category (NULLs excluded), share of all rows, distinct count."""
    total = df.select(F.count(F.lit(1))).scalar()
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("listings"))
    uniq = counts.select(F.count(F.lit(1))).scalar()
    return (counts.withColumn("_rows", total).withColumn("unique_values", uniq)
            .select(col, "listings", _pct(F.col("listings"), F.col("_rows")).alias("share_percent"),
                    "unique_values"))


def top_categories(df: DataFrame, col: str = "neighborhood", k: int = TOP_CATEGORIES) -> DataFrame:
    """The ``k`` most frequent values (ties by name), a top-k taken without a full sort."""
    return (category_profile(df, col).orderBy(F.desc("listings"), F.asc(col)).limit(k)
            .drop("unique_values"))


def boolean_profile(df: DataFrame, col: str = "is_pet_friendly") -> DataFrame:
    c = F.col(col)
    return df.agg(F.count_if(c).alias("true_count"), F.count_if(~c).alias("false_count"),
                  F.count_if(c.isNull()).alias("null_count"))


def date_range(df: DataFrame, cols: Sequence[str] = ("first_seen", "last_seen")) -> DataFrame:
    aggs = []
    for c in cols:
        if c in df.columns:
            aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def completeness(df: DataFrame) -> DataFrame:
    """Non-null cells / all cells × 100 over every column, with its inputs."""
    cols = df.columns
    nn = sum((F.count(F.col(c)) for c in cols), F.lit(0))
    rows = F.count(F.lit(1))
    return df.agg(rows.alias("rows"), F.lit(len(cols)).alias("columns"), nn.alias("non_null_cells")).select(
        "rows", "columns", "non_null_cells",
        F.when(F.col("rows") > 0, F.round(F.col("non_null_cells") * 100.0 / (F.col("rows") * F.col("columns")), 6))
         .otherwise(F.lit(0.0)).alias("completeness_percent"))


def quality_rates(df: DataFrame, key: Sequence[str] = LISTING_KEY,
                  price_window: tuple[float, float] = PRICE_WINDOW) -> DataFrame:
    """Completeness, key uniqueness and validity (rent inside the window and rooms >= 1), in %."""
    lo, hi = price_window
    valid = F.col(TARGET).between(lo, hi) & (F.col("rooms") >= 1)
    cells = sum((F.count(F.col(c)) for c in df.columns), F.lit(0))
    # one scan: counts per key (combined before the shuffle), then their sums
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.count_if(valid).alias("_v"), cells.alias("_c"))
    total = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                        F.coalesce(F.sum("_v"), F.lit(0)).alias("valid_rows"), F.coalesce(F.sum("_c"), F.lit(0)).alias("_c"))
    rows = F.nullif(F.col("rows"), F.lit(0))
    return total.select(
        "rows", "distinct_keys", "valid_rows",
        F.coalesce(F.round(F.col("_c") * 100.0 / (rows * len(df.columns)), 6), F.lit(0.0)).alias("completeness_percent"),
        F.round(F.col("distinct_keys") * 100.0 / rows, 6).alias("uniqueness_percent"),
        F.round(F.col("valid_rows") * 100.0 / rows, 6).alias("validity_percent"))


def summary_stats(df: DataFrame) -> DataFrame:
    """Min, max and mean of rooms and rent, and the number of distinct neighborhoods."""
    return df.agg(F.min("rooms").alias("min_rooms"), F.max("rooms").alias("max_rooms"),
                  F.round(F.avg("rooms"), 6).alias("avg_rooms"),
                  F.min(TARGET).alias("min_rent"), F.max(TARGET).alias("max_rent"),
                  F.round(F.avg(TARGET), 6).alias("avg_rent"),
                  F.count_distinct("neighborhood").alias("neighborhoods"))


def profile_report(df: DataFrame, extraction_time: str, category: str = "neighborhood",
                   flag: str = "is_pet_friendly", k: int = TOP_CATEGORIES) -> DataFrame:
    """The whole profile as one row of nested sections (for the JSON report).

    Every section is bounded by the number of profiled columns or by ``k``;
    the full category distribution stays a table (``category_profile``).
    """
    def section(d: DataFrame):
        """A one-row, one-column aggregate as a scalar subquery (no joins between sections)."""
        return d.select(F.struct(*d.columns).alias("_s")).agg(F.collect_list("_s")).scalar()

    def one_row(d: DataFrame):
        return d.select(F.struct(*d.columns)).scalar()

    # the quantiles feed three sections: computed once
    stats = cut_lineage(numeric_profile(df))
    bounds = stats.select("column_name", (F.col("q1") - IQR_FACTOR * F.col("iqr")).alias("lower_bound"),
                          (F.col("q3") + IQR_FACTOR * F.col("iqr")).alias("upper_bound"))
    top = top_categories(df, category, k)
    uniq = df.where(F.col(category).isNotNull()).select(F.count_distinct(category)).scalar()
    top_map = top.agg(F.map_from_entries(F.collect_list(F.struct(category, "listings")))).scalar()
    return df.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(extraction_time).alias("extraction_time"), "record_count",
        F.lit(len(df.columns)).alias("column_count"),
        section(schema_profile(df)).alias("schema"),
        section(null_distribution(df)).alias("null_distribution"),
        section(stats).alias("numeric_statistics"),
        section(anomaly_profile(df, bounds=bounds)).alias("anomalies"),
        section(outlier_samples(df, bounds=bounds)).alias("outlier_samples"),
        top_map.alias("top_categories"),
        uniq.alias("category_unique_values"),
        one_row(boolean_profile(df, flag)).alias(flag),
        one_row(date_range(df)).alias("date_range"),
        one_row(completeness(df).select("completeness_percent")).alias("completeness"))
