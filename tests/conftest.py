import os
import tempfile

import pytest
from pyspark.sql import SparkSession

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="annomerge-test-")
    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.sql.warehouse.dir": f"{home}/warehouse", "spark.checkpoint.dir": f"file://{home}/shared"}
    session = SparkSession.builder.master("local[*]").appName("tests").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
