import datetime as dt

from pyspark.sql import functions as F

from hearth.schemas import LISTING_SCHEMA, REPLY_SCHEMA, reply_json_schema
from hearth.session import work_dir
from hearth.sources import pages, tables
from tests.conftest import SF_SMALL, rows

T0 = dt.datetime(2024, 1, 1, 12, 30, 15, 123456)


def test_table_lifecycle(spark):
    name = "hearth_listings_t"
    tables.drop_table(spark, name)
    assert not tables.table_exists(spark, name)
    tables.create_listings_table(spark, name)
    tables.create_listings_table(spark, name)  # IF NOT EXISTS
    assert tables.table_exists(spark, name)
    spark.createDataFrame([(1, "a", 10.0, "X", 2, True, T0, T0)], LISTING_SCHEMA).write.insertInto(name)
    assert tables.read_table(spark, name).count() == 1
    tables.drop_table(spark, name)
    assert not tables.table_exists(spark, name)


def test_csv_round_trip_keeps_microseconds_and_fallback(spark):
    df = spark.createDataFrame([(1, "a, b", 10.5, None, 2, None, T0, None)], LISTING_SCHEMA)
    path = work_dir(spark, "csv-test")
    tables.write_csv(df, path)
    back = tables.read_first_available(spark, [("csv", path + "/nope"), ("csv", path)])
    assert rows(back) == rows(df)
    empty = tables.read_first_available(spark, [("parquet", path + "/nope")])
    assert empty.count() == 0 and empty.schema == LISTING_SCHEMA


def test_rows_to_frame_and_reply_schema(spark):
    df = tables.rows_to_frame(spark, [{"id": 3, "title": "t"}], LISTING_SCHEMA)
    assert rows(df, "id", "title", "rooms") == [(3, "t", None)]
    import json
    item = json.loads(reply_json_schema())["properties"]["listings"]["items"]
    assert item["type"] == "object" and item["properties"]["rooms"] == {"type": "integer"} and len(item["required"]) == 5
    assert REPLY_SCHEMA["listings"].dataType.elementType.names == [
        "title", "monthly_rent_eur", "neighborhood", "rooms", "is_pet_friendly"]


def test_page_frontier(spark):
    bases = spark.createDataFrame([("https://x.example/r",)], "base_url string")
    got = [r["url"] for r in pages.page_frontier(bases, 3).orderBy("page_no").collect()]
    assert got == ["https://x.example/r", "https://x.example/r?page=2", "https://x.example/r?page=3"]


def test_alert_once_per_key_and_session(spark):
    from pyspark.sql import Window

    from hearth.streaming import listings as S
    out = spark.read.parquet(S.run_alert_once(spark, SF_SMALL, work_dir(spark, "t-once"), 25.0, "ck", horizon="2 days"))
    assert out.count() > 0 and out.where(F.col("monthly_rent_eur") > 25.0).count() == 0
    before = F.lag("event_time").over(Window.partitionBy("title", "neighborhood").orderBy("event_time"))
    assert out.withColumn("b", before).where("event_time < b + interval 2 days").count() == 0
    # sessions as long as the table's time are still open at its end
    assert spark.read.parquet(S.run_alert_once(spark, SF_SMALL, work_dir(spark, "t-once"), 25.0, "ck", horizon="365 days")).count() == 0
