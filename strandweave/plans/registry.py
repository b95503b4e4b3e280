"""Where queries and their SQL are kept by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import shares, table, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given and derived tables of one folder: ``t.fx_exons``, ``t.documents``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self._spark, self._dir, name)

    def dealt(self, name: str, *keys: str) -> DataFrame:
        """A table derived from ``lineitem``, partitioned by ``keys`` into as many tasks as that needs."""
        return getattr(self, name).repartition(shares(self.lineitem), *keys)


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``f(tables)`` as a query, with the SQL of the same result."""

    def keep(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_fixtures(sql)
        return f

    return keep
