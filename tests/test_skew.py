"""Frequent keys by sketch against plain counts."""

import random

import pytest
from pyspark.sql import functions as F

from strata.functions import skew
from tests.conftest import plan_text


@pytest.mark.parametrize("share", [0.2, 1e-2, 1e-3])
def test_every_frequent_key_is_found_with_its_count(spark, share):
    """A few large keys, two at the border, nulls, and many more rare keys than the sketch has entries."""
    key = (
        F.when(F.col("id") % 10 < 3, 42)
        .when(F.col("id") % 50 == 7, F.lit(None))
        .when(F.col("id") % 500 == 11, F.col("id") % 2)
        .when(F.col("id") % 999 == 5, 99)
        .otherwise(F.xxhash64("id"))
    )
    rows = spark.range(400_000).select(key.alias("k"), F.lit("x").alias("other"))
    want = {r["k"]: r["count"] for r in rows.groupBy("k").count().where(F.col("count") > 400_000 * share).collect()}
    got = {r["k"]: r["_size"] for r in skew.frequent_keys(rows, ["k"], share).collect() if r["_size"] > 400_000 * share}
    assert got == want
    assert {r["k"] for r in skew.hot_keys(rows, ["k"], share, 0).collect()} == set(want)
    assert skew.frequent_keys(rows, ["k"], share).select("_total").distinct().first()[0] == 400_000


def test_candidates_only_are_shuffled(spark):
    rows = spark.range(100_000).select((F.xxhash64("id") % 3).alias("k"), F.xxhash64("id").alias("m"))
    plan = plan_text(skew.hot_keys(rows, ["k", "m"], 1e-2, 0))
    by_key = next(line for line in plan.splitlines() if "Exchange hashpartitioning(k" in line)
    below = plan.split(by_key, 1)[1]
    assert "BroadcastHashJoin" in below.split("Range", 1)[0], "only rows of named keys are counted"
    assert plan.count("Exchange hashpartitioning") == 3, "one by key, two that merge sketches"


def test_no_rows_and_several_columns(spark):
    none = spark.range(0).select("id", F.lit("a").alias("b"))
    assert skew.hot_keys(none, ["id", "b"], 0.1, 0).collect() == []
    draw = random.Random(2)
    pairs = [(draw.randrange(3), draw.choice("ab")) for _ in range(60)]
    rows = spark.createDataFrame(pairs, "x int, y string")
    assert {tuple(r) for r in skew.hot_keys(rows, ["x", "y"], 0.0, 0).collect()} == set(pairs)
    assert skew.found_hot_keys(rows, ["x"], 0.0, 1000) is None
