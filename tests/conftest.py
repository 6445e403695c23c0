import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidelog-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def day(n, month=1, year=2025):
    """A commit instant."""
    return f"{year}{month:02d}{n:02d}000000000"


@pytest.fixture
def make_log(spark):
    def build(*rows):
        data = [(e, c, i, m) for i, (e, c, m) in enumerate(rows)]
        return spark.createDataFrame(data, "entity_id string, commit string, seq long, metric double")

    return build
