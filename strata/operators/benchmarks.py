"""Benchmark rows: storing, ranking and exact medians."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.schemas import columns
from strata.operators.runs import AppendLog

BENCHMARK_SCHEMA = columns(
    bench_id="string",
    ts="timestamp",
    category="string",
    name="string",
    config="texts",
    metrics="texts",
    duration_ms="bigint",
)
# Values of a median are located in blocks of this many milliseconds.
BLOCK_MS = 4096


def record(
    log: AppendLog,
    category: str,
    name: str,
    duration_ms: int,
    config: Mapping[str, object] | None = None,
    metrics: Mapping[str, object] | None = None,
) -> str:
    bench_id = str(uuid.uuid4())
    log.add(
        {
            "bench_id": bench_id,
            "ts": datetime.now(UTC),
            "category": category,
            "name": name,
            "config": dict(config or {}),
            "metrics": dict(metrics or {}),
            "duration_ms": duration_ms,
        }
    )
    return bench_id


def best_by(rows: DataFrame, category: str, first: str, second: str, names: tuple[str, str]):
    """Shortest duration per pair of configuration entries of a category."""
    a, b = (F.try_element_at("config", F.lit(k)) for k in (first, second))
    return (
        rows.where(F.col("category") == category)
        .groupBy(a.alias(names[0]), b.alias(names[1]))
        .agg(F.min("duration_ms").alias("duration_ms"))
        .orderBy(*names)
    )


def best_layouts(rows: DataFrame) -> DataFrame:
    named = rows.where(F.try_element_at("config", F.lit("query")).isNotNull())
    return best_by(named, "layout", "query", "variant", ("query", "variant"))


def best_clusters(rows: DataFrame) -> DataFrame:
    return best_by(rows, "cluster", "workload", "variant", ("workload", "variant"))


def best_rewrites(rows: DataFrame) -> DataFrame:
    return best_by(rows, "query", "case", "phase", ("rewrite_case", "phase"))


def warm_median(runs: DataFrame, name: str = "name", order: str = "ts", tie: str = "bench_id"):
    """Median duration per benchmark without its first run, cut to an integer.

    A benchmark with one run keeps it. The median is exact: values are counted,
    a first window finds the block of values that holds the middle, a second one
    the value inside it. Windows see counts per block or per value, never runs,
    so a benchmark may have any number of them.
    """
    first = runs.groupBy(name).agg(
        F.min_by("duration_ms", F.struct(order, tie)).alias("duration_ms"),
        F.count(F.lit(1)).alias("_runs"),
    )
    # Taking a run away is a count of -1.
    dropped = first.where("_runs > 1").select(name, "duration_ms", F.lit(-1).alias("_n"))
    counted = runs.groupBy(name, "duration_ms").agg(F.count(F.lit(1)).alias("_n"))
    values = (
        counted.unionByName(dropped)
        .groupBy(name, "duration_ms")
        .agg(F.sum("_n").alias("_n"))
        .where("_n > 0")
        .withColumn("_block", F.floor(F.col("duration_ms") / BLOCK_MS))
    )
    before = Window.unboundedPreceding, -1
    along = Window.partitionBy(name).orderBy("_block")
    blocks = (
        values.groupBy(name, "_block")
        .agg(F.sum("_n").alias("_size"))
        .withColumn("_below", F.coalesce(F.sum("_size").over(along.rowsBetween(*before)), F.lit(0)))
        .withColumn("_all", F.sum("_size").over(Window.partitionBy(name)))
        .withColumn("_low", F.floor((F.col("_all") - 1) / 2))
        .withColumn("_high", F.floor(F.col("_all") / 2))
        .where("_below <= _high and _below + _size > _low")
    )
    inside = Window.partitionBy(name, "_block").orderBy("duration_ms").rowsBetween(*before)
    found = (
        values.join(blocks, [name, "_block"])
        .withColumn("_from", F.col("_below") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .where("_from <= _high and _from + _n > _low")
    )
    middle = (F.min("duration_ms") + F.max("duration_ms")) / 2
    return found.groupBy(name).agg(F.floor(middle).cast("bigint").alias("warm_median_ms"))


def as_json_lines(rows: DataFrame) -> DataFrame:
    """Rows ordered by category, name and time, each as one JSON text."""
    shown = ["ts", "category", "name", "config", "metrics", "duration_ms"]
    return rows.orderBy("category", "name", "ts").select(
        F.to_json(F.struct(*shown)).alias("benchmark")
    )


def export_json(rows: DataFrame, path: str) -> None:
    """Write the ordered JSON lines; part files continue one another."""
    as_json_lines(rows).write.mode("overwrite").text(path)
