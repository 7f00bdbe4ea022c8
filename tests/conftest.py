import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("gleaner-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="gleaner-test-ckpt-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from gleaner.session import ship_package

    ship_package(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="gleaner-test-")
