"""Collects the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lectern.plans.views import Tables


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the test tables under ``name``."""
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(build, sql)
        return build
    return register


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return QUERIES[name].build(Tables(spark, folder))
    return run
