"""Streaming ingest of listing observations.

* ``observation_stream``: a file source over the events table, mapped to observations.
* ``run_upsert_stream``: ``foreachBatch`` merges each micro-batch into a table that is
  cut into buckets by a hash of the key. Only the buckets that a batch hits are read and
  written again, under a folder of that batch; log rows (batch, bucket, path) are appended
  after the files are complete, so a replayed batch is skipped or redone from the same input,
  readers only see logged files, and what a batch writes grows with the batch.
* ``run_current_view``: a stateful aggregate of first/last values per key. The view is read from
  the state store itself (``read_current_view``), so nothing is written per batch but the state's
  changes. Late rows cannot overwrite newer ones because the state keeps max_by over the
  sequence, not arrival order.
* ``run_alert_stream``: append-mode alerts to a parquet sink.
* ``run_alert_once``: one alert per key and event-time session: the earliest hit, emitted when
  the session has closed. The result does not depend on how rows are cut into batches.

Every path lives under the shared checkpoint root (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import LISTING_KEY
from ..operators import alerts, upsert, validation
from ..schemas import LISTING_SCHEMA
from ..session import delete_path
from ..sources.adapters import observations_from_events

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _use_rocksdb(spark: SparkSession) -> None:
    key = "spark.sql.streaming.stateStore.providerClass"
    if not spark.conf.get(key, None):
        spark.conf.set(key, ROCKSDB)


def observation_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return observations_from_events(reader.parquet(sf_dir))


TABLE_SCHEMA = T.StructType([LISTING_SCHEMA[c] for c in upsert.TABLE_COLUMNS])
LOG_SCHEMA = "batch_id long, buckets int, bucket int, path string"
BUCKETS = 32  # of a new table; a table keeps the number it was made with
NO_BUCKET = -1  # log row of a batch without rows
KEPT_VERSIONS = 2  # of a bucket: the newest and the one that readers may still hold


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    """The commit log, or None when its path does not exist yet. Any other failure (credentials, an
    unreachable store) is raised: read as "no log" it would start over from an empty table."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/_log")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def latest_paths(spark: SparkSession, root: str, before: int | None = None) -> dict[int, str]:
    """Newest logged folder of every bucket (optionally of batches below ``before``); at most one entry a bucket."""
    log = _log(spark, root)
    if log is None:
        return {}
    if before is not None:
        log = log.where(F.col("batch_id") < before)
    newest = log.where(F.col("bucket") != NO_BUCKET).groupBy("bucket").agg(F.max_by("path", "batch_id").alias("path"))
    return {r["bucket"]: r["path"] for r in newest.collect()}


def _read_buckets(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], TABLE_SCHEMA)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    return _read_buckets(spark, sorted(latest_paths(spark, root).values()))


def is_committed(spark: SparkSession, root: str, batch_id: int) -> bool:
    log = _log(spark, root)
    return log is not None and not log.where(F.col("batch_id") == batch_id).isEmpty()


def table_buckets(spark: SparkSession, root: str, buckets: int = BUCKETS) -> int:
    """The number of buckets a table was made with (``buckets`` for a new one)."""
    log = _log(spark, root)
    row = log.select("buckets").first() if log is not None else None
    return row["buckets"] if row else buckets


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*LISTING_KEY), F.lit(buckets)).cast("int")


def apply_upsert_batch(spark: SparkSession, root: str, batch: DataFrame, batch_id: int, buckets: int = BUCKETS) -> None:
    """Merge one batch of observations into the table (update on conflict), rewriting the buckets it hits.

    A batch already in the log is skipped, so files that readers may be using are never overwritten; an unlogged
    partial write is redone. The log row lists of a batch are appended in one job.
    """
    if is_committed(spark, root, batch_id):
        return
    buckets = table_buckets(spark, root, buckets)
    rows = upsert.rollup_observations(batch).persist()
    try:
        hit = sorted(r["b"] for r in rows.select(_bucket(buckets).alias("b")).distinct().collect())  # at most ``buckets``
        logged = [(batch_id, buckets, NO_BUCKET, None)]
        if hit:
            old = latest_paths(spark, root, before=batch_id)
            target = _read_buckets(spark, [old[b] for b in hit if b in old])
            path = f"{root}/data/v{batch_id:010d}"
            merged = upsert.merge_rolled(target, rows).withColumn("bucket", _bucket(buckets))
            # one file a bucket; beyond what a task should write, AQE splits the rebalanced partitions
            merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
            logged = [(batch_id, buckets, b, f"{path}/bucket={b}") for b in hit]
    finally:
        rows.unpersist()
    spark.createDataFrame(logged, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_log")
    _drop_superseded(spark, root, batch_id, hit)


def _drop_superseded(spark: SparkSession, root: str, batch_id: int, hit: list[int]) -> None:
    """Delete the folders of the buckets just written that are older than their last ``KEPT_VERSIONS`` versions."""
    if not hit:
        return
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/_log").where((F.col("batch_id") <= batch_id) & F.col("bucket").isin(hit))
    version = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("batch_id")))
    # older ones went with earlier batches
    for row in log.withColumn("v", version).where(F.col("v") == KEPT_VERSIONS + 1).collect():
        delete_path(spark, row["path"])


def run_upsert_stream(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Merge the observation stream into snapshots (update on conflict); returns the root."""
    stream = validation.not_null_rows(observation_stream(spark, sf_dir))

    def merge(batch: DataFrame, batch_id: int) -> None:
        apply_upsert_batch(spark, root, batch, batch_id)

    q = (stream.writeStream.foreachBatch(merge)
         .option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return root


def current_view_aggregate(stream: DataFrame) -> DataFrame:
    s = F.col("id")
    return stream.groupBy(*LISTING_KEY).agg(
        F.min_by(F.struct("id", "rooms", "is_pet_friendly", "last_seen"), s).alias("first"),
        F.max_by(F.struct("monthly_rent_eur", "last_seen"), s).alias("last"))


# the state of ``current_view_aggregate``: the value and its order, of each aggregate
_STATE = ("struct<first:struct<id:bigint,rooms:int,is_pet_friendly:boolean,last_seen:timestamp_ntz>,first_at:bigint,"
          "last:struct<monthly_rent_eur:double,last_seen:timestamp_ntz>,last_at:bigint>")


def run_current_view(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Stateful current-listing view; the state store holds it, the stream has no other output."""
    _use_rocksdb(spark)
    agg = current_view_aggregate(validation.not_null_rows(observation_stream(spark, sf_dir)))
    q = (agg.writeStream.outputMode("update").format("noop")
         .option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return root


def read_current_view(spark: SparkSession, root: str, batch_id: int | None = None) -> DataFrame:
    """The view as of the last completed batch (or of ``batch_id``), from the state store."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(f"{root}/_checkpoint").select("key.*", F.col("value").cast(_STATE).alias("v"))
    return state.select("v.first.id", "title", "v.last.monthly_rent_eur", "neighborhood", "v.first.rooms", "v.first.is_pet_friendly",
                        F.col("v.first.last_seen").alias("first_seen"), "v.last.last_seen")


def run_alert_stream(spark: SparkSession, sf_dir: str, root: str, max_rent: float, keyword: str) -> str:
    stream = validation.not_null_rows(observation_stream(spark, sf_dir))
    q = (alerts.alert_rows(stream, max_rent, keyword).writeStream.format("parquet")
         .option("path", f"{root}/alerts").option("checkpointLocation", f"{root}/_checkpoint")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{root}/alerts"


def alert_sessions(hits: DataFrame, horizon: str, late: str) -> DataFrame:
    """One row per key and session of ``hits`` (rows less than ``horizon`` apart): the earliest hit, the number of hits."""
    first = F.min_by(F.struct("id", "monthly_rent_eur", "rooms", "event_time"), F.struct("event_time", "id"))
    return (hits.withColumn("event_time", F.col("last_seen").cast("timestamp")).withWatermark("event_time", late)
            .groupBy(*LISTING_KEY, F.session_window("event_time", horizon)).agg(first.alias("first"), F.count(F.lit(1)).alias("hits"))
            .select("first.id", "title", "first.monthly_rent_eur", "neighborhood", "first.rooms", "first.event_time", "hits"))


def run_alert_once(spark: SparkSession, sf_dir: str, root: str, max_rent: float, keyword: str,
                   horizon: str = "1 day", late: str = "1 day") -> str:
    """One alert per listing key and session of hits less than ``horizon`` apart.

    An alert is written once the watermark (the latest hit less ``late``) has passed the end of its session, so
    sessions still open at the end of the input are not written yet, and the earliest hit is known whatever the order of the rows.
    Rows later than ``late`` are dropped.
    """
    _use_rocksdb(spark)
    stream = validation.not_null_rows(observation_stream(spark, sf_dir))
    alert = alert_sessions(stream.where(alerts.alert_rule(max_rent, keyword)), horizon, late)
    q = (alert.withColumn("message", alerts.alert_message()).writeStream.format("parquet").option("path", f"{root}/alerts")
         .option("checkpointLocation", f"{root}/_checkpoint").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{root}/alerts"
