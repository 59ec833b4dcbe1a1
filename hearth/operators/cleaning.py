"""Cleaning: deduplicate, handle missing values, remove IQR outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import IQR_FACTOR, OUTLIER_COLUMNS, SEED_FILLS, TARGET, UNKNOWN
from .dedup import keep_latest
from .quantiles import fences, method_for


def is_numeric(df: DataFrame, col: str) -> bool:
    return col in df.columns and isinstance(df.schema[col].dataType, T.NumericType)


def drop_missing_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.dropna(subset=[target]) if target in df.columns else df


def impute_category(df: DataFrame, col: str = "neighborhood", value: str = UNKNOWN) -> DataFrame:
    return df.fillna({col: value}) if col in df.columns else df


def handle_missing_values(df: DataFrame) -> DataFrame:
    return impute_category(drop_missing_target(df))


def fill_defaults(df: DataFrame, fills: dict | None = None) -> DataFrame:
    """Fill rent, rooms, pets, title and neighborhood with the seed loader's defaults."""
    fills = dict(SEED_FILLS if fills is None else fills)
    out = df
    for c, v in fills.items():
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(out.schema[c].dataType)))
    return out


def iqr_filter(df: DataFrame, col: str, factor: float = IQR_FACTOR, method: str = "auto") -> DataFrame:
    """Keep rows whose value is NULL or inside the Tukey fences of ``col``."""
    if not is_numeric(df, col):
        return df
    lo, hi = fences(df, col, factor, method)
    c = F.col(col)
    return df.where(c.isNull() | ((c >= lo) & (c <= hi)))


def iqr_outliers(df: DataFrame, col: str, factor: float = IQR_FACTOR, method: str = "auto") -> DataFrame:
    """Rows strictly outside the fences (NULLs are not outliers)."""
    lo, hi = fences(df, col, factor, method)
    c = F.col(col)
    return df.where((c < lo) | (c > hi))


def remove_outliers(df: DataFrame, columns=OUTLIER_COLUMNS, method: str = "auto") -> DataFrame:
    """Columns are screened in order; later fences use the rows that survived earlier ones."""
    if method == "auto":  # the rows of the first table bound those of the later ones
        method = method_for(df)
    for c in columns:
        df = iqr_filter(df, c, method=method)
    return df


def clean_listings(df: DataFrame, tie_cols=("id",), method: str = "auto") -> DataFrame:
    """Deduplicate → drop missing target → fill category → remove outliers.

    The deduplicated table is written once to the shared folder: the fences and the
    filters then read the written table instead of deduplicating the input again.
    """
    from ..session import cut_lineage
    base = cut_lineage(handle_missing_values(keep_latest(df, tie_cols=tie_cols)))
    return remove_outliers(base, method=method)


def clean_audit(df: DataFrame, tie_cols=("id",), method: str = "auto") -> DataFrame:
    """Row counts per cleaning step as one query: (step_no, step, rows_in, rows_out, affected).

    The deduplicated rows are flagged once and counted in a single aggregate,
    instead of one count action per step.
    """
    from ..session import cut_lineage
    dedup = cut_lineage(keep_latest(df, tie_cols=tie_cols))
    if method == "auto":
        method = method_for(dedup)
    rent, nbh = F.col(TARGET), F.col("neighborhood")
    kept = drop_missing_target(dedup)
    rlo, rhi = fences(kept, TARGET, method=method)
    after_rent = kept.where((rent >= rlo) & (rent <= rhi))
    mlo, mhi = fences(after_rent, "rooms", method=method)
    rooms = F.col("rooms")
    flags = dedup.select(
        rent.isNull().alias("_no_target"),
        nbh.isNull().alias("_no_nbh"),
        (rent.isNotNull() & ((rent < rlo) | (rent > rhi))).alias("_rent_out"),
        rooms.alias("_rooms"), rent.alias("_rent"))
    in_rent = F.col("_rent").isNotNull() & ~F.col("_rent_out")
    totals = flags.agg(
        F.count(F.lit(1)).alias("n_dedup"),
        F.count_if(F.col("_no_target")).alias("n_no_target"),
        F.count_if(~F.col("_no_target") & F.col("_no_nbh")).alias("n_imputed"),
        F.count_if(F.col("_rent_out")).alias("n_rent_out"),
        F.count_if(in_rent & ((F.col("_rooms") < mlo) | (F.col("_rooms") > mhi))).alias("n_rooms_out"))
    t = totals.withColumn("n_raw", df.select(F.count(F.lit(1))).scalar())
    n1 = F.col("n_dedup") - F.col("n_no_target")
    n2 = n1 - F.col("n_rent_out")
    n3 = n2 - F.col("n_rooms_out")
    def step(no, name, rows_in, rows_out, affected):
        return F.struct(F.lit(no).alias("step_no"), F.lit(name).alias("step"),
                        rows_in.cast("long").alias("rows_in"), rows_out.cast("long").alias("rows_out"),
                        affected.cast("long").alias("affected"))

    steps = F.array(
        step(1, "deduplicate", F.col("n_raw"), F.col("n_dedup"), F.col("n_raw") - F.col("n_dedup")),
        step(2, "drop_missing_target", F.col("n_dedup"), n1, F.col("n_no_target")),
        step(3, "impute_neighborhood", n1, n1, F.col("n_imputed")),
        step(4, "outliers_monthly_rent_eur", n1, n2, F.col("n_rent_out")),
        step(5, "outliers_rooms", n2, n3, F.col("n_rooms_out")),
    )
    return t.select(F.inline(steps))


def seed_casts(df: DataFrame) -> DataFrame:
    """Text columns (e.g. a CSV read without a schema) to the seed loader's types.

    rent and rooms: number → integer truncated toward zero; pets: boolean; title and
    neighborhood: string. Unparsable text, NaN, infinities and numbers beyond the integer
    range become NULL (a plain cast raises under ANSI mode), so the fills of
    ``fill_defaults`` can apply afterwards.
    """
    out = df
    for c in (TARGET, "rooms"):
        if c in out.columns:
            number = F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double"))
            out = out.withColumn(c, number.try_cast("int"))
    if "is_pet_friendly" in out.columns:
        out = out.withColumn("is_pet_friendly", F.col("is_pet_friendly").try_cast("boolean"))
    for c in ("title", "neighborhood"):
        if c in out.columns:
            out = out.withColumn(c, F.col(c).cast("string"))
    return out
