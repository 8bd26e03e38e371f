"""Costs by sweep against every moment held against every price."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from strata.operators import marts
from tests.conftest import plan_text

START = datetime(2026, 3, 1)
USAGE = "grp string, sku_name string, cloud string, usage_end timestamp, usage_quantity decimal(12,2)"
PRICES = "sku_name string, cloud string, price_start timestamp, price_end timestamp, price decimal(9,2)"


def paired(usage, prices):
    """(dbus, usd) per group, row by row as the left join has it."""
    out = {}
    for grp, sku, cloud, end, quantity in usage:
        rows = [
            p[4] or 0
            for p in prices
            if None not in (sku, cloud, end, p[2]) and (p[0], p[1]) == (sku, cloud) and p[2] <= end and (p[3] is None or end < p[3])
        ]
        sums = out.setdefault(grp, [Decimal(0), Decimal(0)])
        sums[0] += quantity * max(1, len(rows))
        sums[1] += quantity * sum(rows)
    return {grp: (dbus, round(usd, 2)) for grp, (dbus, usd) in out.items()}


def test_every_price_that_holds_counts(spark):
    draw = random.Random(8)
    when = lambda: START + timedelta(hours=draw.randrange(0, 24 * 9))
    usage = [
        (f"g{draw.randrange(7)}", draw.choice(["a", "b", "c", None]), draw.choice(["x", "y"]), draw.choice([when(), when(), None]), Decimal(draw.randrange(1, 400)) / 100)
        for _ in range(600)
    ]
    prices = []
    for _ in range(60):
        start = when()
        end = draw.choice([None, when(), start, start + timedelta(days=2)])  # some end before they begin
        prices.append((draw.choice(["a", "b", "d"]), draw.choice(["x", "y"]), draw.choice([start, start, start, None]), end, draw.choice([None, Decimal(draw.randrange(1, 900)) / 100])))
    usage.append(("edge", "a", "x", START, Decimal("1.50")))
    prices += [("a", "x", START, START + timedelta(days=1), Decimal("2.00")), ("a", "x", START - timedelta(days=1), START, Decimal("9.00"))]
    got = marts.usage_cost(spark.createDataFrame(usage, USAGE), spark.createDataFrame(prices, PRICES), ["grp"], ["sku_name", "cloud"])
    assert got.schema["dbus"].dataType.simpleString() == "decimal(32,2)"
    assert {r["grp"]: (r["dbus"], r["usd"]) for r in got.collect()} == paired(usage, prices)
    assert marts.usage_cost(spark.createDataFrame(usage, USAGE), spark.createDataFrame([], PRICES), ["grp"]).agg(F.sum("usd")).first()[0] == 0
    assert marts.usage_cost(spark.createDataFrame([], USAGE), spark.createDataFrame(prices, PRICES), ["grp"]).collect() == []


def test_one_product_with_many_moments_and_prices(spark):
    """200 000 moments under 400 prices, half of which hold at any time: 4e7 pairs that are never made."""
    usage = spark.range(200_000).select(
        F.lit("hot").alias("sku_name"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("usage_end"),
        F.lit(Decimal("1.00")).cast("decimal(12,2)").alias("usage_quantity"),
    )
    prices = spark.range(400).select(
        F.lit("hot").alias("sku_name"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 500).alias("price_start"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 500 + 100_000).alias("price_end"),
        F.lit(Decimal("0.01")).cast("decimal(9,2)").alias("price"),
    )
    cost = marts.usage_cost(usage, prices, ["sku_name"])
    active = sum(min(t // 500, 399) - max(0, (t - 100_000) // 500 + 1) + 1 for t in range(200_000))
    row = cost.first()
    assert row["dbus"] == active and row["usd"] == round(Decimal(active) / 100, 2)
    plan = plan_text(cost)
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("price_start" not in line and "price_end" not in line and "_at" not in line for line in joins)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
