import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("PYTHONPATH", ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from geoframe.session import register

    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder only when the session has none
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gf-test-ckpt-"))
    register(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_gdb(spark):
    """A fresh geodatabase folder below the shared checkpoint folder."""
    import uuid

    from geoframe.session import local_path, shared_path
    p = shared_path(spark, "tests", uuid.uuid4().hex + ".gdb")
    os.makedirs(local_path(p), exist_ok=True)
    return p
