"""Session construction and the shared work folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",  # only applies when this call starts the JVM (local runs)
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "hearth", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Where the setting is absent, a local master (tests, trial runs) gets a folder of its own;
    on a cluster a machine-local folder would be invisible to the other machines, so that raises.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="hearth-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


_FOLDERS: dict[str, str] = {}


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean_up(spark: SparkSession, path: str) -> None:
    try:
        delete_path(spark, path)
    except Exception:  # noqa: BLE001 - at exit the session may be gone; the shared folder is the cluster's to clean
        pass


def run_folder(spark: SparkSession) -> str:
    """This application's folder under the shared root; deleted when the driver exits."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = f"{checkpoint_root(spark)}/hearth-{uuid.uuid4().hex[:12]}"
        atexit.register(_clean_up, spark, _FOLDERS[app])
    return _FOLDERS[app]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under this application's folder (made by the first write)."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Write ``df`` as parquet to the shared folder and continue from the written copy.

    The copy survives executor loss, keeps column pruning and statistics, and is deleted with
    the application's folder.
    """
    spark = df.sparkSession
    path = work_dir(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
