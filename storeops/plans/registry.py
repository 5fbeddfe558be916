"""Catalogue of named queries: survey row, Spark callable, oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from storeops.plans.oracle import expand
from storeops.sources.mart import Mart


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Mart], DataFrame]
    text: str | None

    @property
    def sql(self) -> str | None:
        """Oracle SQL with the CTEs it needs; None for rows-only queries."""
        return expand(self.text) if self.text else None

    def run(self, spark: SparkSession, path: str) -> DataFrame:
        return self.build(Mart(spark, path))


CATALOGUE: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query; its name starts with the survey row it covers."""

    def add(build: Callable[[Mart], DataFrame]):
        if name in CATALOGUE:
            raise ValueError(f"duplicate query {name}")
        CATALOGUE[name] = Query(name, build, sql)
        return build

    return add
