"""Registered queries: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.plans.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Callable[[Staging], DataFrame]) -> Callable[[Staging], DataFrame]:
    """Register a function of the staging views under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Staging(spark, folder))

    REGISTRY[build.__name__] = run
    return build
