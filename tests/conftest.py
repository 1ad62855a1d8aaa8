import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("feedlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="feedlake-test-"))
    yield s


@pytest.fixture()
def lines(spark):
    """Envelope of literal feed lines, in the given order."""
    from pyspark.sql import functions as F

    from feedlake.sources.feed import messages

    def make(texts):
        df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "line string, n bigint")
        return messages(df.select("line", F.struct("n").alias("pos")))

    return make


@pytest.fixture()
def scratch(spark):
    from feedlake.session import scratch_path

    return lambda name: scratch_path(spark, name)
