import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("argent-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests name their own shared folder only when the session names none.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="argent-tests-ckpt-"))
    yield session


@pytest.fixture(params=["true", "false"], ids=["ansi", "legacy"])
def ansi(spark, request):
    """Run a test under ANSI on and off; results must agree."""
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param == "true"
    spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.fixture
def workdir(spark):
    """A fresh folder under the session's shared folder for this test."""
    from argent.session import scratch_path

    return scratch_path(spark, "test")
