from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import SparkSession

from tidemark.sources.tables import Tables


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "lake"), buckets=4)


def day(n: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2026, 9, 1, hour) + dt.timedelta(days=n - 1)


def rows(df, *columns):
    """The rows of a frame as sorted tuples."""
    found = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in found), key=repr)
