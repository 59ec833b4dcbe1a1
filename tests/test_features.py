import math

from pyspark.sql import functions as F

from hearth.operators import encoding, features, metrics
from hearth.functions.numeric import deal_label
from tests.conftest import rows


def test_mean_encoding_docstring_example(spark):
    df = spark.createDataFrame([(1, "Centru", 500.0), (2, "Periphery", 300.0), (3, "Centru", 550.0)],
                               "id long, neighborhood string, monthly_rent_eur double")
    out = encoding.mean_target_encode(df)
    assert rows(out, "id", "neighborhood") == [(1, 525.0), (2, 300.0), (3, 525.0)]


def test_mean_encoding_null_category_gets_overall_mean(spark):
    df = spark.createDataFrame([(1, "A", 100.0), (2, "A", 200.0), (3, None, 600.0), (4, "B", None)],
                               "id long, neighborhood string, monthly_rent_eur double")
    out = dict(rows(encoding.mean_target_encode(df, out="te"), "id", "te"))
    assert out[1] == 150.0 and out[3] == 300.0 and out[4] == 300.0  # B has only null rents


def test_smoothed_encoder_sigmoid_and_unseen(spark):
    train = spark.createDataFrame([("A", 10.0), ("A", 30.0), ("B", 50.0)], "neighborhood string, monthly_rent_eur double")
    m = encoding.SmoothedTargetEncoder().fit(train)
    test = spark.createDataFrame([(1, "A"), (2, "B"), (3, "Z"), (4, None)], "id long, neighborhood string")
    out = dict(rows(m.transform(test, out="te"), "id", "te"))
    prior = 30.0
    w = 1 / (1 + math.exp(-(2 - 20) / 10))
    assert math.isclose(out[1], prior * (1 - w) + 20.0 * w)
    assert out[2] == prior and out[3] == prior and out[4] == prior  # seen once, unseen, null


def test_m_estimate_option(spark):
    train = spark.createDataFrame([("A", 10.0), ("A", 30.0)], "neighborhood string, monthly_rent_eur double")
    m = encoding.SmoothedTargetEncoder(method="m_estimate", smoothing=2.0).fit(train)
    out = m.transform(spark.createDataFrame([(1, "A")], "id long, neighborhood string"), out="te")
    assert math.isclose(out.collect()[0]["te"], 20.0)


def test_price_per_room_edges(spark):
    df = spark.createDataFrame([(1, 100.0, 0), (2, 100.0, None), (3, None, 2), (4, 90.0, 3)],
                               "id long, monthly_rent_eur double, rooms int")
    out = dict(rows(features.price_per_room(df), "id", "price_per_room"))
    assert out == {1: 0.0, 2: 0.0, 3: None, 4: 30.0}


def test_binary_encoding_null_is_zero_and_idempotent(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id long, is_pet_friendly boolean")
    once = features.binary_encode(df)
    twice = features.binary_encode(once)
    assert rows(once) == rows(twice) == [(1, 1), (2, 0), (3, 0)]


def test_deal_labels_strict_band(spark):
    df = spark.createDataFrame([(110.0,), (111.0,), (90.0,), (89.0,)], "a double").withColumn("p", F.lit(100.0))
    got = [r[0] for r in df.select(deal_label(F.col("a"), F.col("p"))).collect()]
    assert got == ["Fair Price", "Overpriced", "Fair Price", "Great Deal"]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "monthly_rent_eur double, prediction double")
    r = metrics.regression_metrics(df).collect()[0]
    assert math.isclose(r["mae"], 2 / 3, rel_tol=1e-6) and math.isclose(r["r2"], 0.0, abs_tol=1e-9)
