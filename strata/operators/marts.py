"""Business and cost reports over gold tables and usage records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import money, ratio, trailing_days
from strata.operators.star import live_sales


def _total(column: str) -> Column:
    return money(F.sum(column)).alias(column)


def _punctuality() -> Column:
    return ratio(F.sum("on_time"), F.sum("deliveries")).alias("on_time_rate")


def revenue_kpi(daily: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    """Totals of the trailing days. ``orders`` adds the order counts of the
    groups, so an order with lines of two brands counts twice."""
    recent = daily.where(trailing_days("order_date", as_of, days))
    return recent.agg(
        _total("net_revenue"),
        F.sum("units_sold").alias("units_sold"),
        F.sum("orders").alias("orders"),
    )


def on_time_kpi(sla: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return sla.where(trailing_days("planned_date", as_of, days)).agg(_punctuality())


def revenue_trend(daily: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    recent = daily.where(trailing_days("order_date", as_of, days))
    return (
        recent.groupBy("order_date", "brand")
        .agg(_total("net_revenue"))
        .orderBy("order_date", "brand")
    )


def revenue_by_region(daily: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    recent = daily.where(trailing_days("order_date", as_of, days))
    return (
        recent.groupBy("region")
        .agg(_total("net_revenue"), F.sum("units_sold").alias("units_sold"))
        .orderBy(F.col("net_revenue").desc(), "region")
    )


def top_distributors(volume: DataFrame, limit: int = 10) -> DataFrame:
    ranked = volume.groupBy("distributor").agg(
        F.sum("cases_shipped").alias("cases_shipped"), F.sum("shipments").alias("shipments")
    )
    return ranked.orderBy(F.col("cases_shipped").desc(), "distributor").limit(limit)


def sla_trend(sla: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    recent = sla.where(trailing_days("planned_date", as_of, days))
    return (
        recent.groupBy("planned_date", "carrier")
        .agg(_punctuality())
        .orderBy("planned_date", "carrier")
    )


def top_customers(fact: DataFrame, customers: DataFrame, limit: int = 10) -> DataFrame:
    """Customers by net revenue.

    Sums are taken per customer version first. An order belongs to one version,
    so its count carries over to the name and the join moves one row per version.
    """
    per_version = (
        live_sales(fact)
        .groupBy("customer_sk")
        .agg(F.sum("net_amount").alias("_net"), F.countDistinct("order_id").alias("_orders"))
    )
    named = per_version.join(
        customers.select("customer_sk", "customer_name", "region"), "customer_sk"
    )
    return (
        named.groupBy("customer_name", "region")
        .agg(money(F.sum("_net")).alias("net_revenue"), F.sum("_orders").alias("orders"))
        .orderBy(F.col("net_revenue").desc(), "customer_name", "region")
        .limit(limit)
    )


# -- cost ----------------------------------------------------------------


def active_prices(
    moments: DataFrame,
    prices: DataFrame,
    keys: Sequence[str],
    moment: str,
    period: str = "day",
) -> DataFrame:
    """``moments`` (distinct ``keys`` and ``moment``) with ``_active`` prices and their sum ``_rate``.

    A price is a signed event where it starts and the opposite one where it
    ends, so what holds at a moment is the sum of all events up to it, overlaps
    included. A product's events and moments are summed in order, once, in pieces
    of one ``period`` each; a carry row brings in the sum of the pieces before.
    No moment meets a list of prices. Prices without a start, and those that end
    before they begin, hold at no time; a missing price is active and costs 0.
    """
    kind = moments.schema[moment].dataType
    rate = F.coalesce("price", F.lit(0))

    def event(at: str, sign: int) -> Column:
        return F.struct(
            F.col(at).cast(kind).alias("_at"),
            F.lit(1).alias("_order"),
            F.lit(sign).cast("bigint").alias("_active"),
            (rate * sign).alias("_rate"),
        )

    events = (
        prices.where("price_start is not null and (price_end is null or price_end > price_start)")
        .dropna(subset=list(keys))
        .select(*keys, F.explode(F.array(event("price_start", 1), event("price_end", -1))).alias("_event"))
        .select(*keys, "_event.*")
        .where("_at is not null")
    )
    asked = moments.select(*keys, F.col(moment).alias("_at"), F.lit(2).alias("_order"))
    rows = events.unionByName(asked, allowMissingColumns=True)
    rows = rows.withColumn("_piece", F.date_trunc(period, "_at"))
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*keys, "_piece").agg(F.sum("_active").alias("_active"), F.sum("_rate").alias("_rate"))
    carried = carried.select(
        *keys, "_piece", F.lit(0).alias("_order"), *[F.sum(c).over(earlier).alias(c) for c in ("_active", "_rate")]
    )
    so_far = (
        Window.partitionBy(*keys, "_piece")
        .orderBy("_at", "_order")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.unionByName(carried, allowMissingColumns=True).withColumns({c: F.sum(c).over(so_far) for c in ("_active", "_rate")})
    return summed.where("_order = 2").select(
        *keys,
        F.col("_at").alias(moment),
        F.coalesce("_active", F.lit(0)).alias("_active"),
        F.coalesce("_rate", F.lit(0)).alias("_rate"),
    )


def usage_cost(
    usage: DataFrame,
    prices: DataFrame,
    by: Sequence[str],
    keys: Sequence[str] = ("sku_name",),
    moment: str = "usage_end",
    earliest: str | None = None,
) -> DataFrame:
    """Quantity (``dbus``) and cost (``usd``) per group, and ``started`` if asked.

    Usage is summed per group, product and moment, so it is read once and no raw
    row moves, and each product and moment that occurs is priced once, by a sweep
    over the starts and ends of its prices. Usage without a product, a
    moment or a price costs 0; overlapping prices count quantity and cost once
    each. Quantities keep their type, and money is rounded at the end only.
    """
    parts = list(dict.fromkeys([*by, *keys, moment]))
    kept = [F.sum("usage_quantity").alias("_quantity")] + ([F.min(earliest).alias("started")] if earliest else [])
    sums = usage.groupBy(*parts).agg(*kept)
    priced = [*keys, moment]
    # Asking for all columns of the sums, though only their keys matter, lets Spark take one shuffle of the usage for both uses.
    used = sum((F.count(c) for c in sums.columns[len(parts) :]), F.lit(0))
    known = sums.groupBy(*priced).agg(used.alias("_used")).where("_used >= 0").drop("_used")
    rates = active_prices(known, prices, keys, moment)
    quantity = F.sum(F.col("_quantity") * F.greatest(F.coalesce("_active", F.lit(0)), F.lit(1)).cast("int"))
    exact = sums.agg(F.sum("_quantity")).schema[0].dataType
    cost = F.col("_quantity") * F.coalesce("_rate", F.lit(0))
    figures = [quantity.cast(exact).alias("dbus"), money(F.sum(cost)).alias("usd")]
    if earliest:
        figures.append(F.min("started").alias("started"))
    return sums.join(rates, priced, "left").groupBy(*by).agg(*figures)


def cost_daily_by_sku(
    usage: DataFrame, prices: DataFrame, as_of: date, days: int = 30, **options
) -> DataFrame:
    recent = usage.where(trailing_days("usage_date", as_of, days))
    cost = usage_cost(recent, prices, ["usage_date", "sku_name"], **options)
    return cost.orderBy("usage_date", "sku_name")


def cost_per_variant(usage: DataFrame, prices: DataFrame, tag: str, **options) -> DataFrame:
    tagged = usage.withColumn("variant", F.try_element_at("custom_tags", F.lit(tag)))
    cost = usage_cost(tagged.where("variant is not null"), prices, ["variant"], **options)
    return cost.orderBy(F.col("usd").desc(), "variant")


def cost_per_run(
    usage: DataFrame, prices: DataFrame, as_of: date, days: int = 30, limit: int = 50, **options
) -> DataFrame:
    runs = usage.where(trailing_days("usage_date", as_of, days)).select(
        "*",
        F.col("usage_metadata.job_id").alias("job_id"),
        F.col("usage_metadata.job_run_id").alias("run_id"),
    )
    cost = usage_cost(
        runs.where("job_id is not null"),
        prices,
        ["job_id", "run_id"],
        earliest="usage_start",
        **options,
    )
    return cost.orderBy(F.col("started").desc(), "job_id", "run_id").limit(limit)
