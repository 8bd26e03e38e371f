"""Queries that bring gold aggregates from one state to the next by changes alone."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import gold_changes as gold
from strata.operators import merge, star
from strata.operators.deltas import Sums, signed, stated
from strata.plans.merge_queries import FIRST_LOAD, orders_before
from strata.plans.registry import query
from strata.plans.staging import Staging
from strata.session import settled

EARLY_LINES = "ship_date < date '2000-06-01'"
PURGED_LINES = "l_returnflag = 'R' and ship_date < date '1996-01-01'"


def lines_before(s: Staging) -> DataFrame:
    """Lines shipped early; those still open had one unit more."""
    more = F.when(F.col("l_linestatus") == "O", F.col("quantity") + 1).otherwise(F.col("quantity"))
    return s.lines.where(EARLY_LINES).withColumn("quantity", more.cast("int"))


def lines_after(s: Staging) -> DataFrame:
    """All lines but old returns, which are deleted."""
    return s.lines.where(f"not ({PURGED_LINES})")


def customers_before(s: Staging) -> DataFrame:
    """Customers in debt belonged to a region of their own, and have moved since."""
    in_debt = F.when(F.col("credit_limit") < 0, "DEBTORS").otherwise(F.col("region"))
    return star.customer_dimension(s.customer_history.withColumn("region", in_debt))


def products_before(s: Staging) -> DataFrame:
    """Large packages were sold without a brand."""
    return s.products.withColumn("brand", F.when(F.col("package") <= 40, F.col("brand")))


def orders_after(s: Staging) -> DataFrame:
    """Orders as they are, old ones that were sold online deleted."""
    return s.orders.where(f"not (channel = 'online' and modified_at < {FIRST_LOAD})")


def feed(before: DataFrame, after: DataFrame, identity: str, name: str, placed: bool = False) -> DataFrame:
    """The changes between two states as weighted rows, written as a feed table is."""
    return settled(signed(merge.change_feed(before, after.select(*before.columns), identity, placed)), f"feed-{name}")


def followed(table: Sums, before: DataFrame, change: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The state after summed changes, and the changes it went through."""
    state = settled(before, f"state-{name}")
    changes = settled(table.changes(state, change), f"changes-{name}")
    return table.applied(state, changes), changes


@query
def agg_daily_revenue_followed(s: Staging) -> DataFrame:
    """Revenue after inserts, updates and deletes of lines and orders, moved customers and renamed brands."""
    old = gold.SalesTables(lines_before(s), orders_before(s), customers_before(s), products_before(s)).narrowed()
    new = gold.SalesTables(lines_after(s), orders_after(s), star.customer_dimension(s.customer_history), s.products).narrowed()
    # The old lines are met three times, and worked out once, along with what becomes of them. A line
    # has one row in a state, so none comes more often in the pairs.
    pairs = settled(merge.state_pairs(old.lines, new.lines, "order_line_id", placed=True), "pairs-lines")
    old = replace(old, lines=pairs.where("_pre is not null").select("_pre.*"))
    feeds = (
        signed(merge.pair_changes(pairs)),
        feed(old.orders, new.orders, "order_id", "orders"),
        feed(old.customers, new.customers, "customer_sk", "customers"),
        feed(old.products, new.products, "product_id", "products"),
    )
    sales = settled(gold.sales_by_order(old), "state-sales")
    below = settled(gold.SALES_BY_ORDER.changes(sales, gold.sales_changes(old, new, *feeds), cut=False), "changes-sales")
    daily, _ = followed(gold.DAILY_SALES, gold.DAILY_SALES.over(sales), gold.DAILY_SALES.over_changes(below), "daily")
    return gold.daily_revenue(daily)


@query
def agg_delivery_sla_followed(s: Staging) -> DataFrame:
    """Punctuality after open deliveries arrive, dates are corrected and old carriers' rows go."""
    after = s.deliveries.where("not (carrier = 'R' and planned_date < date '1996-01-01')")
    first = F.when(F.col("planned_date") < F.lit("2000-06-01").cast("date"), F.date_add("actual_date", 1))
    before = s.deliveries.where("planned_date < date '2001-01-01'").withColumn("actual_date", first)
    change = gold.DELIVERIES.of(gold.took_place(feed(before, after, "delivery_id", "deliveries")))
    state, _ = followed(gold.DELIVERIES, gold.DELIVERIES.of(stated(gold.took_place(before))), change, "sla")
    return gold.delivery_sla(state)


@query
def agg_distributor_shipments_followed(s: Staging) -> DataFrame:
    """Volume after late shipments, corrected cases and closed warehouses."""
    # The order of a shipment, which no sum asks for, would only take room in the shuffles.
    shipments = s.shipments.drop("order_id")
    after = shipments.where("not (warehouse = 'RF' and ship_date < date '1997-01-01')")
    before = shipments.where("ship_date < date '2000-06-01'").withColumn("warehouse", F.when(F.col("warehouse") != "AF", F.col("warehouse")))
    lower = settled(gold.BY_WAREHOUSE.of(stated(before)), "state-warehouses")
    below = settled(gold.BY_WAREHOUSE.changes(lower, gold.BY_WAREHOUSE.of(feed(before, after, "shipment_id", "shipments", placed=True))), "changes-warehouses")
    state, _ = followed(gold.SHIPMENTS, gold.SHIPMENTS.over(lower), gold.SHIPMENTS.over_changes(below), "volume")
    return gold.distributor_volume(state)
