"""Shared helpers: tables in the shared folder, connected components, ASCII folding."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"

_FOLDERS: dict[str, str] = {}


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def importable(spark: SparkSession) -> None:
    """Let Python workers of this session import the package from where the driver did."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if home not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (home, have) if x)


def small_batches(spark: SparkSession) -> None:
    """From now on this session hands rows to Python in Arrow batches of ``BATCH_BYTES``, unless it sets a limit of its own:
    a task holds a batch several times, in the JVM and in Python."""
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent a folder is made only for a local master (tests); on a cluster a
    machine-local folder would be invisible to the other machines, so that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="hearth-shared-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def _drop(spark: SparkSession, folder: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the session may be gone at exit; the shared folder is the cluster's to clean
        pass


def run_folder(spark: SparkSession) -> str:
    """This application's folder under the shared root; removed when the driver exits."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = f"{shared_root(spark)}/hearth-llm-{uuid.uuid4().hex[:12]}"
        atexit.register(_drop, spark, _FOLDERS[app])
    return _FOLDERS[app]


def written(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors.

    ``few``: for narrow rows (ids, pairs, edges), by no more tasks than twice the cluster's cores, so a
    shuffle's partitions do not become as many files.
    """
    spark = df.sparkSession
    if few:
        df = df.coalesce(2 * spark.sparkContext.defaultParallelism)
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def release(spark: SparkSession) -> None:
    """Run the driver's collector: Spark's cleaner then removes the shuffle files of finished plans."""
    spark.sparkContext._jvm.System.gc()


def free(*tables: DataFrame | None) -> None:
    """Delete tables made by ``written`` that no open plan reads any more (None is skipped), and the shuffle files of
    the plans that wrote them."""
    gone = [t for t in tables if t is not None]
    for t in gone:
        _drop(t.sparkSession, t._written_at)
    if gone:
        release(gone[0].sparkSession)


def kept_rows(docs: DataFrame, placed: DataFrame, key: Column) -> DataFrame:
    """``docs`` without the rows that ``placed`` drops, and one row of each (doc_id, key) that it keeps.

    ``placed``: doc_id, key, rows (of that id and key), kept. ``key``: the same key computed from ``docs``, null
    for rows that all stay; it is computed only for ids whose rows are not decided alike. Ids compare null-safe.
    Of several rows the one whose JSON form is smallest stays. All columns stay.
    """
    placed = written(placed.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "rows", "kept"), "placed", few=True)
    ids = (placed.groupBy(F.col("_id").alias("_of")).agg(F.sum("rows").alias("_rows"), F.max("kept").alias("_some"))
           .where("not _some or _rows > 1"))
    ids = written(ids, "ids", few=True)
    same = F.col("doc_id").eqNullSafe(F.col("_of"))
    out = docs.join(ids, same, "left_anti").select(*docs.columns)
    mixed = ids.where("_some").select("_of")
    if mixed.isEmpty():
        return out
    wanted = placed.where("kept and _key is not null").select("_id", "_key").distinct()
    open_ = docs.join(mixed, same, "left_semi").withColumn("_mine", key)
    row = F.struct(*docs.columns)
    once = (open_.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mine") == F.col("_key")), "left_semi")
            .groupBy("doc_id", "_mine").agg(F.min_by(row, F.to_json(row)).alias("_row")).select("_row.*"))
    return out.unionByName(open_.where("_mine is null").select(*docs.columns)).unionByName(once)


def _oriented(e: DataFrame) -> DataFrame:
    return e.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: one row (node, component) per node that has an edge; the component is
    the smallest node. Null ends and loops are ignored; an empty input gives an empty result.

    Alternating large-star and small-star rounds (a logarithmic number in practice). Neighbours are
    never gathered: each round takes a minimum per node (combined before the shuffle) and a join,
    whose hot keys Spark splits. Every round is written to the shared folder, and the round before is deleted; the
    result reads the last one (``free`` deletes it).
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    e = written(_oriented(e), "edges", few=True)

    def stars(x: DataFrame) -> bool:
        """Whether every node has one edge, to a node that has none of its own."""
        ends = x.groupBy("u").agg(F.count("*").alias("n"))
        many = ends.where("n > 1").select("u").unionByName(x.select("u").join(x.select(F.col("v").alias("u")), "u", "left_semi"))
        return many.isEmpty()

    while not stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pulled = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        before, e = e, written(pulled.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges", few=True)
        free(before)
    out = (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
           .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
    out._written_at = e._written_at
    return out
