import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
# The queries' scale against DuckDB: RETAIL_LAKE_TEST_DIR=/root/testdata/sf0.01 for a larger one.
CHECKED = os.environ.get("RETAIL_LAKE_TEST_DIR", SMALL)


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="retail_lake_tests_")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("retail_lake_tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
