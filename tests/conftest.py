import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from matchlake import config  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[2]")
        .appName("matchlake-tests")
        .config("spark.sql.shuffle.partitions", "2")
        # Little data and many plans: quick compilation beats good code.
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield config.configure(session)
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
