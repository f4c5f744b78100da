import pytest
from pyspark.sql import SparkSession

from bench import LOCAL_CHECKPOINTS


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8,4]")  # tasks may fail three times
        .appName("stratawell-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        # As in bench.py: no process per state file on a local disk.
        .config("spark.sql.streaming.checkpointFileManagerClass", LOCAL_CHECKPOINTS)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
