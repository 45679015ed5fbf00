import time

import pytest
from pyspark.sql import SparkSession

from carelake.session import tune


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("carelake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield tune(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df: sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.fixture
def shuffle_files(spark):
    """Names of the shuffle files on disk; with ``since``, those that came after it and stay."""

    def listed():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for name in disk.getAllFiles().mkString(",").split(",") if "/shuffle_" in name}

    def wait(since=None):
        if since is None:
            return listed()
        for _ in range(50):  # they are removed in the background
            if not listed() - since:
                break
            time.sleep(0.1)
        return listed() - since

    return wait
