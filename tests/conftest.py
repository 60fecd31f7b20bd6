import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hackney.session import get_session
    s = get_session("local[*]", app_name="hackney-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def lines(spark):
    """Build a ``seq, ts, value`` DataFrame from (seq, 'yyyy-mm-dd hh:mm:ss', line)."""
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(rows, "seq bigint, t string, value string")
        return df.select("seq", F.to_timestamp("t").alias("ts"), "value")
    return make
