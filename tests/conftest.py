import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from vitalmart.session import SCALE_CONF
    b = SparkSession.builder.master("local[4]").appName("vitalmart-tests")
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vitalmart-test-"))
    # tests always build their own mart
    from vitalmart.session import RUN_NAMESPACE_CONF
    import uuid
    s.conf.set(RUN_NAMESPACE_CONF, f"test-{uuid.uuid4().hex[:12]}")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="vitalmart-t-")
