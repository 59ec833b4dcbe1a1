"""Table reads and writes: parquet/CSV/JSON, create/drop/exists, fallback chains."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..schemas import LISTING_SCHEMA

# CSV keeps microseconds (the default pattern stops at milliseconds).
CSV_OPTIONS = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
               "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def read_listings(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.options(**CSV_OPTIONS).csv(path)
    return reader.format(fmt).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_first_available(spark: SparkSession, sources: Sequence[tuple[str, str]],
                         schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    """First source that can be read, as (format, path) pairs; an empty table when none can.

    Never fills in made-up rows.
    """
    for fmt, path in sources:
        try:
            df = read_listings(spark, path, fmt, schema)
            df.schema  # resolves the path
            return df
        except AnalysisException:
            continue
    return spark.createDataFrame([], schema)


def rows_to_frame(spark: SparkSession, rows: Iterable[dict], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_json_report(report: DataFrame, path: str) -> None:
    """The one-row report as a single JSON file (one row, so one partition is its natural size)."""
    report.coalesce(1).write.mode("overwrite").options(
        timestampNTZFormat=CSV_OPTIONS["timestampNTZFormat"], timestampFormat=CSV_OPTIONS["timestampFormat"]
    ).json(path)


LISTINGS_DDL = """CREATE TABLE IF NOT EXISTS {name} (
  id BIGINT, title STRING, monthly_rent_eur DOUBLE, neighborhood STRING, rooms INT,
  is_pet_friendly BOOLEAN, first_seen TIMESTAMP_NTZ, last_seen TIMESTAMP_NTZ) USING parquet"""


def create_listings_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create if absent (optionally as an external table at ``location``).

    NOT NULL / UNIQUE are enforced by the validation operators.
    """
    ddl = LISTINGS_DDL.format(name=name)
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
