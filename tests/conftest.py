import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from slotcast.session import pin_utc, scratch_path  # noqa: E402
from slotcast.shipping import ship  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="slotcast-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship(pin_utc(session))
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    return lambda label: scratch_path(spark, label)


@pytest.fixture(scope="session")
def sf():
    return SF
