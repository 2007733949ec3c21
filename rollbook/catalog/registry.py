"""Query registry and table access."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Tables:
    """The Parquet tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run SQL that names tables as {orders}, {events} and so on."""
        used = {n: getattr(self, n) for n in NAMES if "{" + n + "}" in text}
        return self.spark.sql(text, **used)


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None) -> Callable:
    """Register a function of ``Tables`` under its own name."""
    def register(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[run.__name__] = Query(run.__name__, covers, run, sql)
        return run
    return register
