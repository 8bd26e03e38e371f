"""Star schema and its aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import date_number, line_net, ratio, surrogate_key
from strata.operators.history import earliest_and_daily

CUSTOMER_ATTRIBUTES = ("customer_name", "city", "region", "segment", "credit_limit")
PRODUCT_ATTRIBUTES = ("sku", "product_name", "brand", "category", "unit_price", "package")
HISTORY = ("valid_from", "valid_to", "is_current")


def customer_dimension(history: DataFrame) -> DataFrame:
    """One row per customer version; the key is stable for a version."""
    key = surrogate_key("customer_id", "valid_from").alias("customer_sk")
    return history.select(key, "customer_id", *CUSTOMER_ATTRIBUTES, *HISTORY)


def product_dimension(products: DataFrame) -> DataFrame:
    """One row per product, current state only."""
    key = surrogate_key("product_id").alias("product_sk")
    return products.select(key, "product_id", *PRODUCT_ATTRIBUTES)


def calendar_dimension(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last order, without gaps.

    The bounds stay columns of a one-row aggregate, so nothing is collected and
    an order table without rows gives an empty calendar.
    """
    bounds = orders.agg(
        F.min("order_date").cast("date").alias("first"),
        F.max("order_date").cast("date").alias("last"),
    )
    days = bounds.where("first is not null").select(
        F.explode(F.sequence("first", "last")).alias("date")
    )
    weekday = F.dayofweek("date")
    return days.select(
        date_number("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        weekday.alias("day_of_week"),
        ((weekday == 1) | (weekday == 7)).alias("is_weekend"),
    )


def versions_by_day(
    orders: DataFrame, dimension: DataFrame, carried: Sequence[str] = ()
) -> DataFrame:
    """Customer version for every (customer, order day) that occurs, with its ``carried`` columns.

    The answer depends on the customer and the day only, so each pair is solved
    once. A customer has at most one pair and one reduced version per calendar
    day, which bounds the window below however many orders or versions a single
    customer has, and no line is ever compared with a list of versions.
    """
    days = orders.select("customer_id", F.col("order_date").alias("_day")).distinct()
    marks = earliest_and_daily(dimension, "customer_id", ["customer_sk", *(c for c in carried if c not in HISTORY[:2])])
    rows = marks.withColumn("_asks", F.lit(False)).unionByName(
        days.withColumn("_asks", F.lit(True)), allowMissingColumns=True
    )
    # Versions that begin on a day are visible to the orders of that day.
    so_far = (
        Window.partitionBy("customer_id")
        .orderBy("_day", "_asks")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    everything = (
        Window.partitionBy("customer_id")
        .orderBy("_day", "_asks")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    day = F.col("_day").cast(dimension.schema["valid_from"].dataType)
    seen = F.col("_seen")
    holds = seen.isNotNull() & (seen.valid_to.isNull() | (day < seen.valid_to))
    return (
        rows.withColumn("_seen", F.last("_version", ignorenulls=True).over(so_far))
        .withColumn("_earliest", F.first("_first", ignorenulls=True).over(everything))
        .where("_asks")
        .select(
            "customer_id",
            F.col("_day").alias("order_date"),
            *[
                F.when(holds, seen[c]).otherwise(F.col("_earliest")[c]).alias(c)
                for c in ("customer_sk", *carried)
            ],
            holds.alias("in_history"),
        )
    )


def sales_fact(
    lines: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    of_customer: Sequence[str] = (),
    of_product: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """One row per order line with the customer version of the order day.

    Orders older than the history take the earliest version; lines without an
    order drop; lines with an unknown product stay with a NULL product key. The
    customer version is settled on orders, so the lines shuffle only once, on
    their order. Attributes asked for by ``of_customer`` and ``of_product`` come
    along with the keys, so a report needs no second join with a dimension; they
    are NULL where the key is. ``parts`` are the partitions of lines and orders by
    order; without them adaptive execution packs a task by its shuffled bytes, of
    which the sorts and sums over the order take many times as much memory.
    """
    heads = orders.select("order_id", "customer_id", "order_date", "status", "channel")
    settled = heads.join(
        versions_by_day(heads, customers, [c for c in of_customer if c != "customer_id"]).drop("in_history"),
        ["customer_id", "order_date"],
        "left",
    ).withColumn("customer_id", F.when(F.col("customer_sk").isNotNull(), F.col("customer_id")))
    detail = lines.select(
        "order_line_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct"
    )
    if parts:
        detail, settled = detail.repartition(parts, "order_id"), settled.repartition(parts, "order_id")
    return (
        detail.join(settled, "order_id")
        .join(
            products.select(
                F.col("product_id").alias("_known"), "product_sk", *[F.col(c).alias(f"_{c}") for c in of_product]
            ),
            F.col("product_id") == F.col("_known"),
            "left",
        )
        .select(
            "order_line_id",
            "order_id",
            "customer_sk",
            "product_sk",
            date_number("order_date").alias("date_key"),
            "order_date",
            "status",
            "channel",
            "quantity",
            "unit_price",
            "discount_pct",
            line_net("quantity", "unit_price", "discount_pct").alias("net_amount"),
            *of_customer,
            *[F.col(f"_{c}").alias(c) for c in of_product],
        )
    )


def live_sales(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("status") != F.lit("cancelled"))


def daily_revenue(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, units and orders per day, brand and region, cancelled left out.

    Lines are summed per order, customer version and brand before the customer
    join, so that join moves order rows, not lines. An order has one customer
    version, so its rows per brand and region are counted as they are. A fact
    that brings ``brand`` or ``region`` along is not joined for it.
    """
    branded = live_sales(fact)
    if "brand" not in fact.columns:
        branded = branded.join(products.select("product_sk", "brand"), "product_sk")
    known = F.col("product_sk").isNotNull() & F.col("customer_sk").isNotNull()
    region = ["region"] if "region" in fact.columns else []
    per_order = (
        branded.where(known)
        .groupBy("order_date", "order_id", "customer_sk", "brand", *region)
        .agg(F.sum("net_amount").alias("_net"), F.sum("quantity").alias("_units"))
    )
    if not region:
        per_order = per_order.join(customers.select("customer_sk", "region"), "customer_sk")
    return per_order.groupBy("order_date", "brand", "region").agg(
        F.sum("_net").cast("decimal(24,2)").alias("net_revenue"),
        F.sum("_units").alias("units_sold"),
        F.count(F.lit(1)).alias("orders"),
    )


def delivery_sla(deliveries: DataFrame) -> DataFrame:
    """Punctuality per planned day and carrier; open deliveries do not count."""
    late_by = F.datediff("actual_date", "planned_date")
    return (
        deliveries.where("actual_date is not null")
        .groupBy("planned_date", "carrier")
        .agg(
            F.count(F.lit(1)).alias("deliveries"),
            F.count_if(late_by <= 0).alias("on_time"),
            F.avg(late_by).alias("avg_delay_days"),
        )
        .withColumn("on_time_rate", ratio(F.col("on_time"), F.col("deliveries")))
    )


def distributor_volume(shipments: DataFrame) -> DataFrame:
    """Shipments, cases and warehouses used per day and distributor."""
    return shipments.groupBy("ship_date", "distributor").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum("qty_cases").alias("cases_shipped"),
        F.countDistinct("warehouse").alias("warehouses_used"),
    )
