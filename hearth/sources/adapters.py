"""Views of the driver's test tables as listing tables.

``observations`` maps the ``events`` table to listing observations and
``sales_listings`` maps ``lineitem`` joined with ``part`` to a larger
listing table. Both keep every source row; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nan_to_null(c: Column) -> Column:
    """pandas treats NaN as missing; Spark does not, so map NaN to NULL on read."""
    return F.nanvl(c, F.lit(None).cast("double"))


def event_k(props: Column) -> Column:
    """The integer ``k`` carried in the events' JSON ``props``."""
    return F.get_json_object(props, "$.k").cast("int")


def observations_from_events(events: DataFrame, extra: dict | None = None) -> DataFrame:
    """One listing observation per event (id, title, rent, neighborhood, rooms, pets, seen).

    ``extra`` maps further output names to functions of the event's ``k`` column.
    """
    k = F.col("_k")
    more = [fn(k).alias(name) for name, fn in (extra or {}).items()]
    return (events
            .withColumn("_k", event_k(F.col("props")))
            .select(
                F.col("event_id").alias("id"),
                F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("title"),
                F.when(k % 25 == 0, F.lit(None).cast("double"))
                 .otherwise(nan_to_null(F.col("value"))).alias("monthly_rent_eur"),
                F.when(k % 33 == 0, F.lit(None).cast("string"))
                 .otherwise(F.col("event_type")).alias("neighborhood"),
                (F.lit(1) + k % 6).cast("int").alias("rooms"),
                F.when(k % 10 < 2, F.lit(True))
                 .when(k % 10 == 2, F.lit(None).cast("boolean"))
                 .otherwise(F.lit(False)).alias("is_pet_friendly"),
                F.col("ts").alias("first_seen"),
                F.col("ts").alias("last_seen"),
                *more,
            ))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations_from_events(table(spark, sf_dir, "events"))


# Tie-breakers for the sales view, where (l_orderkey, l_linenumber) is not unique.
SALES_ORDER = ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


def sales_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined with part, shaped like a listing table.

    The planner broadcasts ``part`` only when its scanned size is under the
    broadcast threshold; beyond it the join is a sort-merge join on partkey.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return j.select(
        F.col("p_name").alias("title"),
        nan_to_null(F.col("l_extendedprice")).alias("monthly_rent_eur"),
        F.col("p_brand").alias("neighborhood"),
        (F.lit(1) + F.col("p_size") % 6).cast("int").alias("rooms"),
        F.when(F.col("l_returnflag") == "R", F.lit(True))
         .when(F.col("l_returnflag") == "N", F.lit(False))
         .otherwise(F.lit(None).cast("boolean")).alias("is_pet_friendly"),
        F.col("l_shipdate").alias("last_seen"),
        *[F.col(c) for c in SALES_ORDER],
    )


def requests_from_events(events: DataFrame) -> DataFrame:
    """Scoring requests derived from events, one per event.

    neighborhood and pets follow the observation view (so nulls occur),
    rooms = k % 6 (so the invalid 0 occurs) and the asking price is the
    observed rent.
    """
    k = F.col("_k")
    return (events
            .withColumn("_k", event_k(F.col("props")))
            .select(
                F.col("event_id").alias("request_id"),
                F.when(k % 33 == 0, F.lit(None).cast("string"))
                 .otherwise(F.col("event_type")).alias("neighborhood"),
                (k % 6).cast("int").alias("rooms"),
                F.when(k % 10 < 2, F.lit(True))
                 .when(k % 10 == 2, F.lit(None).cast("boolean"))
                 .otherwise(F.lit(False)).alias("is_pet_friendly"),
                nan_to_null(F.col("value")).alias("asking_price"),
            ))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from_events(table(spark, sf_dir, "events"))
