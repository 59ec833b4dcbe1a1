import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master("local[*]").appName("hearth-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="hearth-test-ckpt-"))
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="hearth-test-wh-")))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted([tuple(r[c] for c in cols) for r in df.select(*cols).collect()], key=repr)
