from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def put(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored(tables, folder):
    """The tables read back from Parquet, as they would be in use."""
    found = {}
    for name, table in tables.items():
        table.coalesce(1).write.parquet(f"{folder}/{name}")
        found[name] = table.sparkSession.read.parquet(f"{folder}/{name}")
    return found


@pytest.fixture(scope="session")
def shop(spark, tmp_path_factory):
    """Small film-rental tables with all the awkward rows."""
    from tests.fixtures import film_rental

    return stored(film_rental(spark), tmp_path_factory.mktemp("shop"))


@pytest.fixture(scope="session")
def seeds(spark, tmp_path_factory):
    """Two rows per fleet table, with natural keys."""
    from tests.fixtures import fleet_seeds

    return stored(fleet_seeds(spark), tmp_path_factory.mktemp("fleet"))
