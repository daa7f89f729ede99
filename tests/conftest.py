import logging
import tempfile

import pytest
from pyspark.sql import SparkSession

logging.getLogger("py4j").setLevel(logging.ERROR)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("railwatch-tests")
        .config("spark.sql.shuffle.partitions", "3").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="railwatch-tests-"))
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
