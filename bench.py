"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and materialised with a no-op write (the whole result is
computed, nothing is collected to the driver) $BENCH_RUNS times (default 2). The
metric is the sum of the per-query best times; the first-run times are reported
as ``cold_queries``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hearth.plans.catalogue import QUERIES  # noqa: E402
from hearth.session import get_session  # noqa: E402

HEADLINE = [
    "clean_sales", "clean_listings", "clean_audit", "dedup_latest", "profile_numeric", "profile_anomalies",
    "outlier_samples", "quality_rates", "category_summary_having", "engineer_features",
    "target_encode_smoothed", "metrics_by_category", "upsert_update", "upsert_ignore", "observation_rollup",
    "page_text", "page_gate", "reply_listings", "deal_labels", "scoring_responses", "stream_upsert",
    "profile_report",
]

# rows handled per query, for throughput figures (pages = pages, events = events)
THROUGHPUT = {"page_gate": ("pages", "pages_to_text_per_sec"),
              "reply_listings": ("events", "reply_listings_per_sec")}


def model_figures(spark, sf_dir: str) -> dict:
    """The saved rent model: fit, cold load and first score, warm one-row p50, batch throughput."""
    from hearth.operators import model as M
    from hearth.operators import validation
    from hearth.plans.catalogue import _split
    from hearth.session import work_dir
    from hearth.sources import adapters

    t0 = time.perf_counter()
    fitted = M.fit_model(_split(spark, sf_dir)[0])
    out = {"fit_sec": round(time.perf_counter() - t0, 3)}
    path = M.save_model(fitted, work_dir(spark, "bench-model"))
    requests = validation.validate_requests(adapters.requests(spark, sf_dir)).where("reject_reason is null")
    one = requests.limit(1).collect()
    row = spark.createDataFrame(one, requests.schema)
    t0 = time.perf_counter()
    model = M.load_model(path, spark)
    M.predict(model, row).collect()
    out["cold_load_and_score_sec"] = round(time.perf_counter() - t0, 3)
    times = []
    for _ in range(9):
        t0 = time.perf_counter()
        M.predict(model, row).collect()
        times.append(time.perf_counter() - t0)
    out["one_row_p50_sec"] = round(sorted(times)[4], 4)
    t0 = time.perf_counter()
    M.predict(model, requests).write.format("noop").mode("overwrite").save()
    out["scored_requests_per_sec"] = round(requests.count() / (time.perf_counter() - t0), 1)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", int(cpus) * 2, app_name="hearth-bench",
                        extra={"spark.driver.memory": "16g"})
    # warm-up: JVM start, parquet footers, codegen caches
    QUERIES["dedup_latest"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    times, cold = {}, {}
    for name in names:
        best = None
        for i in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            el = time.perf_counter() - t0
            if i == 0:
                cold[name] = round(el, 3)
            best = el if best is None else min(best, el)
        times[name] = round(best, 3)
    rates = {}
    for name, (tbl, label) in THROUGHPUT.items():
        if name in times and times[name] > 0:
            n = spark.read.parquet(f"{sf_dir}/{tbl}.parquet").count()
            rates[label] = round(n / times[name], 1)
    model = model_figures(spark, sf_dir) if names == HEADLINE else {}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "cold_queries": cold, "runs": runs, "throughput": rates, "model": model,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))


if __name__ == "__main__":
    main()
