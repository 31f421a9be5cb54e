import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file:{tmp_path_factory.mktemp('shared')}")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def partitions(spark):
    """Set the number of shuffle partitions for one test, without merging small ones."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"

    def use(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        spark.conf.set(merge, "false")

    yield use
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set(merge, "true")
