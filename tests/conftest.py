import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def bars(spark):
    """Build silver rows from (series, day offset, close) triples or closes of one series."""
    import datetime as dt

    from tidemark.schema import SILVER

    def make(rows):
        start, out = dt.date(2024, 1, 1), []
        for r in rows:
            series, day, close = r
            at = start + dt.timedelta(days=day)
            millis = int(dt.datetime(at.year, at.month, at.day, tzinfo=dt.timezone.utc).timestamp() * 1000)
            out.append((series, at, float(close), float(close), float(close), float(close), 1, millis))
        return spark.createDataFrame(out, SILVER)

    return make
