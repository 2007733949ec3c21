from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tests").config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", ""):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """frame("a int, b string", rows) -> DataFrame; short rows are filled with NULL."""
    def make(ddl, rows):
        width = len(spark.createDataFrame([], ddl).columns)
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], ddl)
    return make


@pytest.fixture(scope="session")
def named(spark):
    """named(ddl, dict, dict, ...) -> DataFrame; missing columns are NULL."""
    def make(ddl, *rows):
        columns = spark.createDataFrame([], ddl).columns
        for r in rows:
            assert set(r) <= set(columns), set(r) - set(columns)
        return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], ddl)
    return make


def values(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
