"""Skew and plan-shape checks: hot keys stay correct and are combined before the shuffle."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.operators import upsert
from hearth.operators.dedup import keep_latest, keep_latest_window
from hearth.operators.quantiles import quantiles
from hearth.schemas import LISTING_SCHEMA
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def skewed(spark, n=30000):
    """A third of all rows share one key."""
    df = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 997).cast("string")))
         .alias("title"),
        (F.col("id") % 500).cast("double").alias("monthly_rent_eur"),
        F.lit("X").alias("neighborhood"), (F.col("id") % 4 + 1).cast("int").alias("rooms"),
        (F.col("id") % 2 == 0).alias("is_pet_friendly"),
        F.lit(T0).cast("timestamp_ntz").alias("first_seen"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") % 60).cast("int"))
         ).alias("last_seen"))
    return spark.createDataFrame(df.rdd, LISTING_SCHEMA).repartition(8)


def test_hot_key_dedup_matches_window(spark):
    df = skewed(spark)
    assert rows(keep_latest(df)) == rows(keep_latest_window(df))


def test_dedup_combines_before_shuffle(spark):
    plan = keep_latest(skewed(spark))._jdf.queryExecution().executedPlan().toString()
    # a partial (map-side) aggregate sits below the hash exchange on the key
    assert "partial_max_by" in plan
    assert plan.index("Exchange hashpartitioning(title") < plan.index("partial_max_by")


def test_hot_key_rollup(spark):
    df = skewed(spark)
    hot = [r for r in upsert.rollup_observations(df).collect() if r["title"] == "hot"][0]
    assert hot["id"] == 0 and hot["monthly_rent_eur"] == float((29997) % 500)


@pytest.mark.parametrize("hot", [False, True])
def test_bracketed_quantiles_equal_exact(spark, hot):
    rng = np.random.default_rng(7)
    vals = np.round(rng.lognormal(3, 1, 4000), 2)
    if hot:
        vals = np.concatenate([vals, np.full(2000, 12.5)])
    df = spark.createDataFrame([(float(x),) for x in vals], "x double").repartition(4)
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    exact = quantiles(df, "x", probs, method="exact").first()["q"]
    from hearth.operators.quantiles import bracketed_quantiles
    dist = bracketed_quantiles(df, {"x": probs}, inside=50)["x"]
    plain = quantiles(df, "x", probs).first()["q"]
    assert [round(a, 9) for a in plain] == [round(a, 9) for a in exact]
    assert [round(a, 9) for a in exact] == [round(b, 9) for b in dist]
    assert np.allclose(dist, np.quantile(vals, probs))


def test_top_k_is_taken_without_full_sort(spark):
    from hearth.operators.profiling import top_categories
    plan = top_categories(skewed(spark), "title")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_outlier_samples_limit_before_shuffle(spark):
    from hearth.operators.profiling import outlier_samples
    df = outlier_samples(skewed(spark))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_profile_reads_only_needed_columns(spark):
    import __spark_entry__ as E
    df = E.queries()["profile_numeric"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,value:double,props:string>" in plan or \
        "ReadSchema: struct<value:double,props:string>" in plan


def test_profile_methods_agree(spark):
    from hearth.operators.profiling import anomaly_profile, numeric_profile
    df = skewed(spark, 6000)
    assert rows(numeric_profile(df)) == rows(numeric_profile(df, method="bracketed"))
    assert rows(anomaly_profile(df)) == rows(anomaly_profile(df, method="bracketed"))


def test_brackets_over_several_columns_nulls_and_nan(spark):
    """Two scans for all columns and probabilities; NaN ranks last, null does not count, a hot value may fill a bracket."""
    from hearth.operators.quantiles import bracketed_quantiles
    rng = np.random.default_rng(11)
    a = np.round(rng.lognormal(1, 2, 30_000), 3)
    a[::3] = 7.0
    b = rng.integers(0, 4, 30_000).astype(float)
    data = [(float(x), float(y), None if i % 5 else float(i), float("nan") if i % 2 else 1.0, None, float("-inf") if i % 4 else float("inf"))
            for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double, f double").repartition(5)
    probs = (0.0, 0.2, 0.25, 0.5, 0.75, 1.0)
    got = bracketed_quantiles(df, {c: probs for c in "abcdef"}, inside=500)
    for c in "abcd":
        want = quantiles(df, c, probs, method="exact").first()["q"]
        assert np.allclose(got[c], want, equal_nan=True, rtol=1e-12), c
    assert got["e"] == [None] * 6 and got["f"][:4] == [float("-inf")] * 4 and got["f"][5] == float("inf")
    assert np.allclose(got["a"], np.quantile(a, probs))


def test_a_bracket_that_missed_is_widened(spark, monkeypatch):
    """A sketch has no certain error: with brackets far too narrow the counts notice it and the result is still exact."""
    from hearth.operators import quantiles as Q
    made = []

    class Narrow(Q.Bracket):
        def __init__(self, column, prob, lo=None, hi=None, rows=None, eps=0.0):
            super().__init__(column, prob, lo, hi, rows, eps or 1e-12)
            made.append(self.eps)

    monkeypatch.setattr(Q, "Bracket", Narrow)
    monkeypatch.setattr(Q, "SKETCH_K", 8)
    vals = np.random.default_rng(5).normal(size=20_000)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(6)
    got = Q.bracketed_quantiles(df, {"x": (0.3, 0.5)})["x"]
    assert np.allclose(got, np.quantile(vals, (0.3, 0.5)), rtol=1e-12) and max(made) > 1e-12


def test_fences_of_large_tables_reach_the_scan(spark, tmp_path, monkeypatch):
    """Beyond the bound of the exact method the fences are literals, pushed down to the parquet scan."""
    from hearth.operators import cleaning
    from hearth.operators import quantiles as Q
    path = f"{tmp_path}/t"
    spark.range(5000).select("id", (F.col("id") % 997).cast("double").alias("x")).write.parquet(path)
    monkeypatch.setattr(Q, "INSIDE", 100)
    df = cleaning.iqr_filter(spark.read.parquet(path), "x")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(x," in plan.split("PushedFilters")[1] and df.count() == 5000
