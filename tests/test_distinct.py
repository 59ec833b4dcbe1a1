"""Stored distinct-count sketches: united days, replaced days, nulls, hot values."""

import datetime as dt

from pyspark.sql import functions as F

from hearth.operators import distinct as op

COLS = ["title", "rooms"]


def listings(spark, days, per_day, first=0):
    """Every day repeats half of the titles of the day before; a third of all rows have one title."""
    n = days * per_day
    i = F.col("id")
    title = F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (i - F.floor(i / per_day) * (per_day / 2)).cast("long").cast("string")))
    return spark.range(n).select(
        title.alias("title"), F.when(i % 7 != 0, i % 9).alias("rooms"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), F.floor(i / per_day).cast("int") + first).alias("day"))


def estimates(sketches):
    return {r["column_name"]: (r["days"], r["estimate"]) for r in op.distinct_estimates(sketches).collect()}


def test_united_days_are_near_the_exact_count(spark):
    df = listings(spark, 12, 6000)
    sk = op.distinct_sketches(df, COLS, F.col("day"))
    assert sk.count() == 24
    rows = op.compare_with_exact(op.distinct_estimates(sk), df, COLS).collect()
    assert {r["column_name"]: (r["days"], r["exact"], r["within_error"]) for r in rows} == {
        "title": (12, df.select("title").distinct().count(), True), "rooms": (12, 9, True)}
    whole = estimates(op.distinct_sketches(df, COLS, F.lit(None)))["title"][1]
    assert abs(whole - estimates(sk)["title"][1]) <= 2 * op.SIGMAS * op.ERROR * whole


def test_a_day_written_again_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "sketches")
    op.store_sketches(op.distinct_sketches(listings(spark, 3, 300), COLS, F.col("day")), path)
    before = estimates(spark.read.parquet(path))
    for _ in range(2):  # a replay changes nothing
        op.store_sketches(op.distinct_sketches(listings(spark, 1, 300, first=2).withColumn("title", F.lit("one")), COLS, F.col("day")), path)
    stored = spark.read.parquet(path)
    assert estimates(stored)["title"][0] == before["title"][0] == 3
    assert estimates(stored.where("day = '2024-01-03'"))["title"] == (1, 1)
    assert estimates(stored.where("day < '2024-01-03'")) == estimates(
        op.distinct_sketches(listings(spark, 3, 300).where("day < '2024-01-03'"), COLS, F.col("day")))


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None, None), (None, 1, dt.date(2024, 1, 1)), (None, 1, None)], "title string, rooms int, day date")
    assert estimates(op.distinct_sketches(df, COLS, F.col("day"))) == {"title": (2, 0), "rooms": (2, 1)}
    rows = op.compare_with_exact(op.distinct_estimates(op.distinct_sketches(df, COLS, F.col("day"))), df, COLS).collect()
    assert all(r["within_error"] for r in rows) and len(rows) == 2
    assert estimates(op.distinct_sketches(df.limit(0), COLS, F.col("day"))) == {}
