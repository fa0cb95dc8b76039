import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from pixtrend.session import DEFAULT_CONF

    b = SparkSession.builder.master("local[4]").appName("pixtrend-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests run locally: a private checkpoint folder only when none is configured
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="pixtrend-test-")
        s.sparkContext.setCheckpointDir(d)
        s.conf.set("spark.checkpoint.dir", d)
    yield s
    s.stop()
