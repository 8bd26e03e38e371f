"""The gold aggregates, kept from the changes of the tables below them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import line_net, ratio
from strata.operators.deltas import ROWS, WEIGHT, Sums, joined, joined_change, stated
from strata.operators.rows import matched
from strata.operators.star import live_sales, versions_by_day

#: Sales of an order by brand, and what a day, brand and region has of them.
SALES_BY_ORDER = Sums(
    ["order_id", "order_date", "brand", "region"],
    {
        "net": (lambda: line_net("quantity", "unit_price", "discount_pct"), "decimal(24,2)"),
        "units": (lambda: F.col("quantity"), "bigint"),
    },
)
DAILY_SALES = SALES_BY_ORDER.rolled_up(["order_date", "brand", "region"], "orders")

#: Punctuality of deliveries that took place.
DELIVERIES = Sums(
    ["planned_date", "carrier"],
    {
        "late": (lambda: F.datediff("actual_date", "planned_date"), "bigint"),
        "punctual": (lambda: (F.datediff("actual_date", "planned_date") <= 0).cast("int"), "bigint"),
    },
)

#: Shipments by warehouse, and what a day and distributor has of them.
BY_WAREHOUSE = Sums(["ship_date", "distributor", "warehouse"], {"cases": (lambda: F.col("qty_cases"), "bigint")})
SHIPMENTS = BY_WAREHOUSE.rolled_up(["ship_date", "distributor"], "warehouses_used", lambda: F.col("warehouse").isNotNull())


@dataclass(frozen=True)
class SalesTables:
    """What revenue is made of, in one state: lines, orders, the customer dimension, products with their brand."""

    lines: DataFrame
    orders: DataFrame
    customers: DataFrame
    products: DataFrame

    def narrowed(self) -> SalesTables:
        """The tables with the keys of their rows and what revenue asks of them."""
        return SalesTables(
            self.lines.select("order_line_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct"),
            self.orders.select("order_id", "customer_id", "order_date", "status"),
            self.customers.select("customer_sk", "customer_id", "region", "valid_from", "valid_to"),
            self.products.select("product_id", "brand"),
        )

    def heads(self) -> DataFrame:
        return live_sales(self.orders).select("order_id", "customer_id", "order_date")

    def details(self) -> DataFrame:
        return self.lines.select("order_id", "product_id", "quantity", "unit_price", "discount_pct")

    def brands(self) -> DataFrame:
        return self.products.select("product_id", "brand")


def _with_region(heads: DataFrame, customers: DataFrame) -> DataFrame:
    """(order_id, order_date, region) of orders whose customer is known, by the version of the day."""
    known = matched(customers, heads.select("customer_id"), ["customer_id"], "left_semi")
    versions = versions_by_day(heads, known, ["region"]).where("customer_sk is not null")
    return heads.join(versions.select("customer_id", "order_date", "region"), ["customer_id", "order_date"]).select("order_id", "order_date", "region")


def sales_by_order(tables: SalesTables) -> DataFrame:
    """All sales, as ``SALES_BY_ORDER`` keeps them."""
    rows = tables.details().join(tables.brands(), "product_id").join(_with_region(tables.heads(), tables.customers), "order_id")
    return SALES_BY_ORDER.of(stated(rows))


def sales_changes(
    old: SalesTables, new: SalesTables, lines: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """What weighted changes of the four tables do to the sales by order, summed.

    Orders are looked at again if they changed or if their customer's versions
    did; which version a day takes is a matter of all versions of a customer, so
    these orders leave with their old region and come back with the new one.
    """
    moved = customers.select("customer_id").distinct()
    touched = orders.select("order_id")
    for state in (old, new):
        touched = touched.union(matched(state.heads(), moved, ["customer_id"], "left_semi").select("order_id"))
    touched = touched.distinct()
    again = lambda state: _with_region(matched(state.heads(), touched, ["order_id"], "left_semi"), state.customers)
    heads = stated(again(new)).unionByName(again(old).withColumn(WEIGHT, F.lit(-1).cast("bigint")))

    detail = joined_change(
        old.details(),
        lines.select("order_id", "product_id", "quantity", "unit_price", "discount_pct", WEIGHT),
        new.brands(),
        products.select("product_id", "brand", WEIGHT),
        "product_id",
    )
    # Changed lines meet the new orders, lines as they were the changes of orders.
    met = matched(new.heads(), detail.select("order_id"), ["order_id"], "left_semi")
    by_line = joined(detail, stated(_with_region(met, new.customers)), "order_id")
    before = old.details().join(old.brands(), "product_id")
    by_order = joined(stated(before), heads, "order_id")
    return SALES_BY_ORDER.of(by_line.unionByName(by_order))


def daily_revenue(sales: DataFrame) -> DataFrame:
    """The aggregate by day, brand and region from its table of sums."""
    return sales.select(
        "order_date",
        "brand",
        "region",
        DAILY_SALES.value("net").alias("net_revenue"),
        DAILY_SALES.value("units").alias("units_sold"),
        "orders",
    )


def took_place(deliveries: DataFrame) -> DataFrame:
    return deliveries.where("actual_date is not null")


def delivery_sla(sums: DataFrame) -> DataFrame:
    """The punctuality by planned day and carrier from its table of sums."""
    return sums.select(
        "planned_date",
        "carrier",
        F.col(ROWS).alias("deliveries"),
        F.col("punctual").alias("on_time"),
        ratio(F.col("late"), F.col("late_n")).alias("avg_delay_days"),
        ratio(F.col("punctual"), F.col(ROWS)).alias("on_time_rate"),
    )


def distributor_volume(sums: DataFrame) -> DataFrame:
    """The volume by day and distributor from its table of sums."""
    return sums.select("ship_date", "distributor", F.col(ROWS).alias("shipments"), SHIPMENTS.value("cases").alias("cases_shipped"), "warehouses_used")
