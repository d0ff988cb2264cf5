import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from erpspark.session import SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="erpspark-wh-"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    """A fresh schema name factory."""
    made = []

    def make(prefix: str) -> str:
        name = f"{prefix}_{len(made)}_{os.urandom(3).hex()}"
        spark.sql(f"CREATE DATABASE {name}")
        made.append(name)
        return name

    yield make
    for name in made:
        spark.sql(f"DROP DATABASE {name} CASCADE")
