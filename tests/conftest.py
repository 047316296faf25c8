import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from saleslens.session import configure
    s = (SparkSession.builder.master("local[*]").appName("saleslens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):      # tests choose their own only when unset
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="saleslens-test-ckpt-"))
    configure(s)
    yield s
    s.stop()


@pytest.fixture()
def work(spark):
    from saleslens.session import fresh_dir
    return lambda label: fresh_dir(spark, label)
