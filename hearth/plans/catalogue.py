"""The query catalogue: name → (spark, sf_dir) → DataFrame.

Every query reads the driver's tables (through the adapters in
``hearth.sources.adapters``) and runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import TARGET
from ..functions.hashing import is_train, split_bucket
from ..functions.numeric import deal_label, default_false, to_eur
from ..operators import (alerts, cleaning, deals, distinct, encoding, features, metrics, profiling, replies,
                         reports, upsert, validation)
from ..operators import model as M
from ..operators.dedup import keep_latest
from ..session import cut_lineage, work_dir
from ..sources import adapters, pages, tables
from ..streaming import listings as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _obs(spark, d):
    return adapters.observations(spark, d)


def _clean(spark, d):
    return cleaning.clean_listings(_obs(spark, d))


def _r6(c):
    return F.round(c, 6)


# --- cleaning ---------------------------------------------------------------

@query("clean_listings")
def q_clean_listings(spark, d):
    return _clean(spark, d)


@query("clean_sales")
def q_clean_sales(spark, d):
    return cleaning.clean_listings(adapters.sales_listings(spark, d), tie_cols=adapters.SALES_ORDER)


@query("dedup_latest")
def q_dedup_latest(spark, d):
    return keep_latest(_obs(spark, d))


@query("dedup_no_timestamp")
def q_dedup_no_timestamp(spark, d):
    return keep_latest(_obs(spark, d).drop("last_seen"))


@query("clean_audit")
def q_clean_audit(spark, d):
    return cleaning.clean_audit(_obs(spark, d))


@query("impute_category")
def q_impute_category(spark, d):
    return cleaning.handle_missing_values(_obs(spark, d))


@query("fill_defaults")
def q_fill_defaults(spark, d):
    f = cleaning.fill_defaults(_obs(spark, d))
    return f.select("id", F.col("title").cast("string").alias("title"),
                    F.col(TARGET).cast("int").alias(TARGET),
                    F.col("neighborhood").cast("string").alias("neighborhood"),
                    F.col("rooms").cast("int").alias("rooms"),
                    F.col("is_pet_friendly").cast("boolean").alias("is_pet_friendly"))


@query("iqr_filter")
def q_iqr_filter(spark, d):
    return cleaning.iqr_filter(_obs(spark, d), TARGET)


@query("iqr_outliers")
def q_iqr_outliers(spark, d):
    return cleaning.iqr_outliers(_obs(spark, d), TARGET)


# --- reads and reports --------------------------------------------------------

@query("read_projected")
def q_read_projected(spark, d):
    return reports.read_projected(_obs(spark, d))


@query("latest_first")
def q_latest_first(spark, d):
    return reports.latest_first(_clean(spark, d))


@query("kpi_summary")
def q_kpi_summary(spark, d):
    return reports.kpi_summary(_clean(spark, d))


@query("mean_by_category")
def q_mean_by_category(spark, d):
    return reports.mean_by_category(_clean(spark, d))


@query("category_summary_having")
def q_category_summary_having(spark, d):
    return reports.category_summary(_obs(spark, d))


# --- profile ------------------------------------------------------------------

@query("profile_schema")
def q_profile_schema(spark, d):
    return profiling.schema_profile(_obs(spark, d))


@query("profile_nulls")
def q_profile_nulls(spark, d):
    return profiling.null_distribution(_obs(spark, d))


@query("profile_numeric")
def q_profile_numeric(spark, d):
    p = profiling.numeric_profile(_obs(spark, d))
    return p.select("column_name", "count", *[_r6(F.col(c)).alias(c) for c in
                                         ("mean", "median", "std", "min", "max", "q1", "q3", "iqr")])


@query("profile_anomalies")
def q_profile_anomalies(spark, d):
    p = profiling.anomaly_profile(_obs(spark, d))
    return p.select("column_name", _r6(F.col("lower_bound")).alias("lower_bound"),
                    _r6(F.col("upper_bound")).alias("upper_bound"), "outlier_count", "outlier_percent")


@query("outlier_samples")
def q_outlier_samples(spark, d):
    return profiling.outlier_samples(_obs(spark, d))


@query("outlier_values")
def q_outlier_values(spark, d):
    """Every outlier value per column; the samples and the report show the first five."""
    return profiling.outlier_values(_obs(spark, d))


@query("category_distribution")
def q_category_distribution(spark, d):
    """The whole distribution of the category in the cleaned table, largest first."""
    p = profiling.category_profile(_clean(spark, d)).drop("unique_values")
    return p.orderBy(F.desc("listings"), "neighborhood")


@query("profile_categories")
def q_profile_categories(spark, d):
    return profiling.category_profile(_obs(spark, d))


@query("distinct_sketches")
def q_distinct_sketches(spark, d):
    """Distinct counts from stored sketches of every day, against the exact ones."""
    cols = ("title", "neighborhood", "rooms", TARGET)
    obs = _obs(spark, d)
    path = work_dir(spark, "sketches")
    distinct.store_sketches(distinct.distinct_sketches(obs, cols, F.col("last_seen")), path)
    return distinct.compare_with_exact(distinct.distinct_estimates(spark.read.parquet(path)), obs, cols)


@query("profile_boolean")
def q_profile_boolean(spark, d):
    return profiling.boolean_profile(_obs(spark, d))


@query("top_categories")
def q_top_categories(spark, d):
    return profiling.top_categories(_obs(spark, d))


@query("completeness_score")
def q_completeness_score(spark, d):
    return profiling.completeness(_obs(spark, d))


@query("quality_rates")
def q_quality_rates(spark, d):
    return profiling.quality_rates(_obs(spark, d))


@query("date_range")
def q_date_range(spark, d):
    return profiling.date_range(_obs(spark, d))


# --- validation -----------------------------------------------------------------

@query("key_violations")
def q_key_violations(spark, d):
    return validation.key_violations(_obs(spark, d))


@query("null_violations")
def q_null_violations(spark, d):
    return validation.null_violations(_obs(spark, d)).select("id", "title", "neighborhood", TARGET, "violations")


@query("price_window")
def q_price_window(spark, d):
    """Observations whose rent lies in the documented plausible window (inclusive)."""
    return validation.within_price_window(_obs(spark, d)).select("id", "title", "neighborhood", TARGET)


@query("request_validation")
def q_request_validation(spark, d):
    return validation.validate_requests(adapters.requests(spark, d)).drop("asking_price")


# --- features and encodings -----------------------------------------------------

@query("price_per_room")
def q_price_per_room(spark, d):
    return features.price_per_room(_clean(spark, d)).select("id", TARGET, "rooms", "price_per_room")


@query("binary_encode")
def q_binary_encode(spark, d):
    return features.binary_encode(_clean(spark, d)).select("id", "is_pet_friendly")


@query("target_encode_mean")
def q_target_encode_mean(spark, d):
    e = encoding.mean_target_encode(_clean(spark, d), "neighborhood", TARGET, out="neighborhood_te")
    return e.select("id", "neighborhood", _r6(F.col("neighborhood_te")).alias("neighborhood_te"))


@query("engineer_features")
def q_engineer_features(spark, d):
    e = features.engineer_features(_clean(spark, d))
    return e.select("id", _r6(F.col("neighborhood")).alias("neighborhood"), "rooms", "is_pet_friendly",
                    _r6(F.col("price_per_room")).alias("price_per_room"), TARGET)


def _split(spark, d):
    """Train and test rows of the cleaned table, which is cleaned once and written: both and the encoder read it."""
    c = cut_lineage(_clean(spark, d))
    return c.where(is_train(F.col("id"))), c.where(~is_train(F.col("id")))


@query("hash_split")
def q_hash_split(spark, d):
    c = _clean(spark, d)
    return c.select("id", split_bucket(F.col("id")).alias("bucket"), is_train(F.col("id")).alias("is_train"))


def _smoothed(spark, d):
    train, test = _split(spark, d)
    return encoding.SmoothedTargetEncoder().fit(train), train, test


@query("target_encode_smoothed")
def q_target_encode_smoothed(spark, d):
    model, _, test = _smoothed(spark, d)
    t = model.transform(test, out="neighborhood_te")
    return t.select("id", "neighborhood", _r6(F.col("neighborhood_te")).alias("neighborhood_te"))


@query("baseline_metrics")
def q_baseline_metrics(spark, d):
    train, test = _split(spark, d)
    mean = train.select(F.avg(TARGET)).scalar()
    return metrics.regression_metrics(test.withColumn("prediction", mean))


@query("metrics_by_category")
def q_metrics_by_category(spark, d):
    model, _, test = _smoothed(spark, d)
    scored = model.transform(test, out="prediction")
    return metrics.metrics_by_group(scored, "neighborhood")


@query("category_vocabulary")
def q_category_vocabulary(spark, d):
    model, train, test = _smoothed(spark, d)
    return reports.category_vocabulary(train.unionByName(test), model.vocabulary())


# --- upserts ---------------------------------------------------------------------

def _upsert_inputs(spark, d):
    """Valid observations split at the midpoint of their time range: before → target, after → batch."""
    valid = validation.not_null_rows(_obs(spark, d))
    # midpoint on the wall clock (TIMESTAMP_NTZ arithmetic, independent of the session time zone)
    mid = valid.select(F.expr(
        "timestampadd(MICROSECOND, timestampdiff(MICROSECOND, min(last_seen), max(last_seen)) div 2, "
        "min(last_seen))")).scalar()
    return valid.where(F.col("last_seen") < mid), valid.where(F.col("last_seen") >= mid)


@query("upsert_update")
def q_upsert_update(spark, d):
    before, after = _upsert_inputs(spark, d)
    return upsert.upsert_update(upsert.rollup_observations(before), after)


@query("upsert_ignore")
def q_upsert_ignore(spark, d):
    before, after = _upsert_inputs(spark, d)
    target = keep_latest(before).select(*upsert.TABLE_COLUMNS)
    return upsert.upsert_ignore(target, after.select(*upsert.TABLE_COLUMNS))


@query("observation_rollup")
def q_observation_rollup(spark, d):
    return upsert.rollup_observations(validation.not_null_rows(_obs(spark, d)))


# --- pages and replies -------------------------------------------------------------

def _pages(spark, d):
    return adapters.table(spark, d, "pages")


@query("page_frontier")
def q_page_frontier(spark, d):
    return pages.frontier_from_pages(_pages(spark, d))


@query("page_text")
def q_page_text(spark, d):
    return pages.page_texts(_pages(spark, d)).select("page_id", "text", "n_chars")


@query("page_gate")
def q_page_gate(spark, d):
    return pages.gate_pages(_pages(spark, d))


def _replies(spark, d):
    return replies.render_replies(_obs(spark, d))


@query("reply_repair")
def q_reply_repair(spark, d):
    return replies.repair_replies(_replies(spark, d))


@query("reply_validate")
def q_reply_validate(spark, d):
    return replies.validate_replies(_replies(spark, d))


@query("reply_listings")
def q_reply_listings(spark, d):
    return replies.reply_listings(_replies(spark, d))


@query("reply_ingest")
def q_reply_ingest(spark, d):
    """The ingest step: replies → accepted listings of every page at once → one upsert batch into a
    snapshot table. Listings are sequenced by (reply, position); ``observed_at`` is explicit."""
    observed = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    lst = replies.reply_listings(_replies(spark, d))
    batch = lst.select((F.col("reply_id") * 1000 + F.col("position")).alias("id"), "title",
                       F.col(TARGET).cast("double").alias(TARGET), "neighborhood", "rooms", "is_pet_friendly",
                       observed.alias("first_seen"), observed.alias("last_seen"))
    root = work_dir(spark, "reply-ingest")
    S.apply_upsert_batch(spark, root, batch, 0)
    return S.read_snapshot(spark, root)


@query("currency_normalise")
def q_currency_normalise(spark, d):
    """Prices quoted in RON for every fourth k (rent × 5), normalised back to EUR."""
    ron = {"currency": lambda k: F.when(k % 4 == 0, F.lit("RON")).otherwise(F.lit("EUR"))}
    o = adapters.observations_from_events(adapters.table(spark, d, "events"), extra=ron)
    quoted = F.when(F.col("currency") == "RON", F.col(TARGET) * 5.0).otherwise(F.col(TARGET))
    return o.select("id", "currency", _r6(quoted).alias("price"),
                    _r6(to_eur(quoted, F.col("currency"))).alias("price_eur"),
                    default_false(F.col("is_pet_friendly")).alias("is_pet_friendly"))


@query("alert_rows")
def q_alert_rows(spark, d):
    return alerts.alert_rows(validation.not_null_rows(_obs(spark, d)), max_rent=25.0, keyword="ck")


# --- deals ---------------------------------------------------------------------------

def _scored_requests(spark, d, model):
    req = validation.validate_requests(adapters.requests(spark, d)).where(F.col("reject_reason").isNull())
    req = req.where(F.col("asking_price").isNotNull())
    return model.transform(req, out="predicted_rent_eur").withColumn(
        "predicted_rent_eur", F.round("predicted_rent_eur", 2))


@query("deal_labels")
def q_deal_labels(spark, d):
    lab = deals.label_deals(_scored_requests(spark, d, _smoothed(spark, d)[0]))
    return lab.select("request_id", "asking_price", "predicted_rent_eur", _r6(F.col("max_fair")).alias("max_fair"),
                      _r6(F.col("min_fair")).alias("min_fair"), _r6(F.col("delta_percent")).alias("delta_percent"),
                      "deal", _r6(F.abs(F.col("delta_percent"))).alias("abs_delta_percent"))


@query("deal_quality")
def q_deal_quality(spark, d):
    model, train, test = _smoothed(spark, d)
    lab = deals.label_deals(_scored_requests(spark, d, model))
    means = train.unionByName(test).groupBy("neighborhood").agg(F.avg(TARGET).alias("_true_pred"))
    j = lab.join(means, "neighborhood", "left")
    j = j.withColumn("true_deal", deal_label(F.col("asking_price"), F.col("_true_pred")))
    return deals.deal_quality(j)


# --- model ---------------------------------------------------------------------------
# The model queries share one documented default fit (``constants.DEFAULT_MODEL``); ``cv_results`` is the
# whole search: 15 sampled maps, 3 folds.

def _fit(spark, d):
    train, test = _split(spark, d)
    return M.fit_model(train), train, test


def _valid_requests(spark, d):
    return validation.validate_requests(adapters.requests(spark, d)).where(F.col("reject_reason").isNull())


@query("gbt_predictions")
def q_gbt_predictions(spark, d):
    model, _, _ = _fit(spark, d)
    loaded = M.load_model(M.save_model(model, work_dir(spark, "rent-model")), spark)
    return M.predict(loaded, _valid_requests(spark, d).drop("reject_reason"))


@query("model_inputs")
def q_model_inputs(spark, d):
    """The encoded inputs that the trees are trained on: distinct vectors, their rows and mean target."""
    train, _ = _split(spark, d)
    train = M.training_frame(train)
    c = M.collapsed(M.model_inputs(train, M.fit_encoder(train)))
    return c.select(_r6(F.col("neighborhood_te")).alias("neighborhood_te"), "rooms_f", "pets01", "weight",
                    _r6(F.col(TARGET)).alias(TARGET))


@query("cv_results")
def q_cv_results(spark, d):
    return M.cross_validate(_split(spark, d)[0])


@query("feature_importance")
def q_feature_importance(spark, d):
    """Shares of the inputs in the mean absolute Shapley value over the training rows."""
    return M.feature_importance(_fit(spark, d)[0])


@query("prediction_contributions")
def q_prediction_contributions(spark, d):
    """Exact Shapley values of every valid request's predicted rent, one column per feature."""
    model = _fit(spark, d)[0]
    out = model.contributions(_valid_requests(spark, d).drop("reject_reason"))
    return out.select("request_id", "prediction", *[f"phi_{c}" for c in M.FEATURES])


@query("model_nodes")
def q_model_nodes(spark, d):
    """The fitted trees as a table of nodes."""
    return _fit(spark, d)[0].nodes


@query("model_metrics")
def q_model_metrics(spark, d):
    """MAE, RMSE, R² and MAPE of the default model on the held-out split, with the train-mean
    baseline's MAE and the model's gain over it in percent."""
    model, train, test = _fit(spark, d)
    scored = model.transform(M.training_frame(test))
    base = metrics.regression_metrics(test.withColumn("prediction", train.select(F.avg(TARGET)).scalar()))
    base_mae = base.select("mae").scalar()
    return metrics.regression_metrics(scored).select(
        "*", base_mae.alias("baseline_mae"),
        F.round((F.lit(1.0) - F.col("mae") / base_mae) * 100.0, 6).alias("gain_percent"))


@query("gbt_deal_labels")
def q_gbt_deal_labels(spark, d):
    """Every valid request priced by the saved and reloaded model, labelled against its asking price."""
    model = M.load_model(M.save_model(_fit(spark, d)[0], work_dir(spark, "rent-model")), spark)
    req = _valid_requests(spark, d).where(F.col("asking_price").isNotNull()).drop("reject_reason")
    lab = deals.label_deals(M.predict(model, req))
    return lab.select("request_id", "asking_price", "predicted_rent_eur", "deal", deals.deal_message().alias("message"))


# --- streaming -------------------------------------------------------------------------
# Each runs an availableNow stream to completion under the shared checkpoint root and
# returns the written result.

@query("stream_upsert")
def q_stream_upsert(spark, d):
    return S.read_snapshot(spark, S.run_upsert_stream(spark, d, work_dir(spark, "stream-upsert")))


@query("stream_current")
def q_stream_current(spark, d):
    return S.read_current_view(spark, S.run_current_view(spark, d, work_dir(spark, "stream-current")))


@query("stream_alerts")
def q_stream_alerts(spark, d):
    return spark.read.parquet(S.run_alert_stream(spark, d, work_dir(spark, "stream-alerts"), 25.0, "ck"))


@query("stream_alert_once")
def q_stream_alert_once(spark, d):
    """One alert per key and session of hits, for sessions that closed before the last hit less the delay."""
    return spark.read.parquet(S.run_alert_once(spark, d, work_dir(spark, "stream-alert-once"), 25.0, "ck"))


# --- summaries, report and file round trip ---------------------------------------------

@query("summary_stats")
def q_summary_stats(spark, d):
    return profiling.summary_stats(_clean(spark, d))


@query("profile_report")
def q_profile_report(spark, d):
    """The full profile of the cleaned table as one nested row, written as JSON and read back."""
    clean = _clean(spark, d).persist()  # every section reads it; spills to disk when large
    try:
        report = profiling.profile_report(clean, extraction_time="2024-01-31T00:00:00")
        path = work_dir(spark, "profile-report")
        tables.write_json_report(report, path)
    finally:
        clean.unpersist()
    return spark.read.json(path)


@query("csv_roundtrip")
def q_csv_roundtrip(spark, d):
    """Cleaned listings exported as CSV with a header and read back with the listing schema."""
    path = work_dir(spark, "listings-csv")
    tables.write_csv(_clean(spark, d), path)
    return tables.read_first_available(spark, [("csv", f"{path}/missing"), ("csv", path)])


@query("export_features")
def q_export_features(spark, d):
    """Clean, engineer, export as CSV with a header, and read the export back."""
    path = work_dir(spark, "features-csv")
    e = q_engineer_features(spark, d)
    tables.write_csv(e, path)
    return spark.read.schema(e.schema).options(**tables.CSV_OPTIONS).csv(path)


@query("table_lifecycle")
def q_table_lifecycle(spark, d):
    """Create a listings table (external, under the shared folder), insert the cleaned rows, check it
    exists, read it in full, drop it; the data stays at its location and is returned."""
    import uuid
    name = f"listings_{uuid.uuid4().hex[:10]}"
    location = work_dir(spark, "listings-table")
    tables.create_listings_table(spark, name, location)
    _clean(spark, d).select(*upsert.TABLE_COLUMNS).write.insertInto(name)
    if not tables.table_exists(spark, name):
        raise RuntimeError(f"table {name} was not created")
    n = tables.read_table(spark, name).count()
    tables.drop_table(spark, name)
    out = spark.read.parquet(location)
    if out.count() != n:
        raise RuntimeError("external table data changed on drop")
    return out


@query("scoring_responses")
def q_scoring_responses(spark, d):
    """Validated requests answered as JSON bodies: {"predicted_rent_eur": x} or the rejection reason."""
    model, _, _ = _smoothed(spark, d)
    req = validation.validate_requests(adapters.requests(spark, d))
    scored = model.transform(req, out="_p")
    body = F.when(F.col("reject_reason").isNull(),
                  F.to_json(F.struct(F.round("_p", 2).alias("predicted_rent_eur"))))
    return scored.select("request_id", body.alias("response"), "reject_reason")


@query("seed_load")
def q_seed_load(spark, d):
    """The CSV seed flow: observations written as CSV text, read back without a schema (all text),
    cast with try_cast and truncation, defaults filled, then inserted with ignore-on-conflict
    into an empty table (the first row per key in file order wins)."""
    path = work_dir(spark, "seed-csv")
    obs = _obs(spark, d).select("id", "title", TARGET, "neighborhood", "rooms", "is_pet_friendly")
    tables.write_csv(obs, path)
    text = spark.read.options(**tables.CSV_OPTIONS).csv(path)  # every column is a string here
    batch = cleaning.fill_defaults(cleaning.seed_casts(text.withColumn("id", F.col("id").cast("long"))))
    empty = spark.createDataFrame([], batch.schema)
    return upsert.upsert_ignore(empty, batch)
