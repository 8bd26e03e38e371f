"""Queries over conformance and star schema operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import conform, star
from strata.plans.lake import SHIPMENTS
from strata.plans.registry import query
from strata.plans.staging import Staging


def dimensions(s: Staging) -> tuple[DataFrame, DataFrame]:
    return star.customer_dimension(s.customer_history), star.product_dimension(s.products)


def fact(s: Staging, of_customer: Sequence[str] = (), of_product: Sequence[str] = ()) -> DataFrame:
    return star.sales_fact(s.lines, s.orders, *dimensions(s), of_customer, of_product, s.line_parts)


#: Business keys that stand for the surrogates in a comparison.
CUSTOMER_KEYS, PRODUCT_KEYS = ("customer_id", "segment", "valid_from"), ("product_id",)


def readable(fact_rows: DataFrame) -> DataFrame:
    """Fact that brings its business keys along, without the surrogates."""
    return fact_rows.drop("customer_sk", "product_sk")


@query
def revenue_by_brand_segment(s: Staging) -> DataFrame:
    """Flagship: point-in-time revenue by brand and customer segment."""
    sold = star.live_sales(fact(s, ["segment"], ["brand"]))
    return (
        sold.where("customer_sk is not null and product_sk is not null")
        .groupBy("brand", "segment")
        .agg(
            F.sum("net_amount").cast("decimal(18,2)").alias("net_revenue"),
            F.sum("quantity").alias("units_sold"),
        )
    )


@query
def latest_per_key(s: Staging) -> DataFrame:
    lines = s.line_versions.drop("p_partkey", "p_retailprice")
    return conform.newest_version(lines, "order_line_id", "l_shipdate")


@query
def apply_casts(s: Staging) -> DataFrame:
    """Shipments as text, some values broken, brought to their types."""
    text = s.shipments.select(
        F.col("shipment_id").cast("string").alias("shipment_id"),
        F.col("order_id").cast("string").alias("order_id"),
        "distributor",
        F.when(F.col("shipment_id") % 11 == 0, "soon")
        .otherwise(F.col("ship_date").cast("string"))
        .alias("ship_date"),
        F.when(F.col("shipment_id") % 7 == 0, "n/a")
        .otherwise(F.col("qty_cases").cast("string"))
        .alias("qty_cases"),
        "warehouse",
        F.lit("extra").alias("undeclared"),
        F.lit("{}").alias("_rescued_data"),
        F.concat(F.lit("drop-"), F.col("warehouse")).alias("_source_file"),
    )
    return conform.declare(text, SHIPMENTS.types)


def known_customers(s: Staging) -> DataFrame:
    return s.customers.where("segment <> 'MACHINERY'")


@query
def referential_violations(s: Staging) -> DataFrame:
    return conform.orphans(s.orders, known_customers(s), "customer_id")


@query
def orders_ref_violations(s: Staging) -> DataFrame:
    return conform.orphan_count(
        s.orders, known_customers(s), "customer_id", "orders_ref_violations"
    )


@query
def dim_customer(s: Staging) -> DataFrame:
    return star.customer_dimension(s.customer_history)


@query
def dim_product(s: Staging) -> DataFrame:
    return star.product_dimension(s.products)


@query
def dim_date(s: Staging) -> DataFrame:
    return star.calendar_dimension(s.orders)


@query
def fact_sales(s: Staging) -> DataFrame:
    return readable(fact(s, CUSTOMER_KEYS, PRODUCT_KEYS))


@query
def fact_sales_fallback(s: Staging) -> DataFrame:
    """History that starts 400 days late: earlier orders take the first version."""
    late = s.customer_history.withColumns(
        {
            "valid_from": F.col("valid_from") + F.expr("interval 400 days"),
            "valid_to": F.col("valid_to") + F.expr("interval 400 days"),
        }
    )
    customers, products = star.customer_dimension(late), star.product_dimension(s.products)
    return readable(star.sales_fact(s.lines, s.orders, customers, products, CUSTOMER_KEYS, PRODUCT_KEYS, s.line_parts))


@query
def agg_daily_revenue(s: Staging) -> DataFrame:
    return star.daily_revenue(fact(s, ["region"], ["brand"]), *dimensions(s))


@query
def agg_delivery_sla(s: Staging) -> DataFrame:
    return star.delivery_sla(s.deliveries)


@query
def agg_distributor_shipments(s: Staging) -> DataFrame:
    return star.distributor_volume(s.shipments)


@query
def gold_table_counts(s: Staging) -> DataFrame:
    """Row count of every gold table after a full rebuild."""
    customers, products = dimensions(s)
    sales = star.sales_fact(s.lines, s.orders, customers, products, parts=s.line_parts)
    tables = {
        "dim_customer": customers,
        "dim_product": products,
        "dim_date": star.calendar_dimension(s.orders),
        "fact_sales": sales,
        "agg_daily_revenue": agg_daily_revenue(s),
        "agg_delivery_sla": star.delivery_sla(s.deliveries),
        "agg_distributor_shipments": star.distributor_volume(s.shipments),
    }
    return row_counts(tables)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    union = None
    for name, rows in tables.items():
        one = rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        union = one if union is None else union.unionByName(one)
    return union
