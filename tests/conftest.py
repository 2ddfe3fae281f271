import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("strata-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from strata.session import ensure_checkpoint_dir

    if not s.conf.get("spark.checkpoint.dir", None):
        ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="strata-test-ck-"))
    yield s


@pytest.fixture
def tmp_table(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture
def sf():
    return SF001
