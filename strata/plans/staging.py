"""Business entities derived from the given tables."""

from __future__ import annotations

import math
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.windows import first_by
from strata.operators.history import full_history
from strata.sources.tables import scan


LINES_PER_TASK = 500_000


class Staging:
    """Lazy entity views over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._scans: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._scans:
            self._scans[name] = scan(self.spark, self.folder, name)
        return self._scans[name]

    @cached_property
    def customers(self) -> DataFrame:
        nation = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("region"),
                F.col("c_mktsegment").alias("segment"),
                F.col("c_acctbal").cast("decimal(12,2)").alias("credit_limit"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.concat(F.lit("SKU-"), F.col("p_partkey")).alias("sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(9,2)").alias("unit_price"),
            F.col("p_size").alias("package"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        status = (
            F.when(key % 33 == 0, "cancelled")
            .when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "P", "shipped")
            .otherwise("placed")
        )
        channel = F.when(key % 3 == 0, "direct").when(key % 3 == 1, "distributor")
        return self.raw("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            status.alias("status"),
            channel.otherwise("online").alias("channel"),
            F.col("o_orderdate").alias("modified_at"),
        )

    @cached_property
    def line_versions(self) -> DataFrame:
        """Lines as delivered, where a line id can occur several times."""
        return (
            self.raw("lineitem")
            .join(
                self.raw("part").select("p_partkey", "p_retailprice"),
                F.col("l_partkey") == F.col("p_partkey"),
            )
            .withColumn("order_line_id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
        )

    @cached_property
    def lines(self) -> DataFrame:
        return self._newest_lines(self.line_versions)

    def lines_dealt(self, parts: int) -> DataFrame:
        """The lines, dealt over ``parts`` partitions by the shuffle that finds the newest of each.

        All versions of a line come to one task, as nothing is cut before this shuffle.
        """
        return self._newest_lines(self.line_versions.repartition(parts, "order_line_id"))

    def _newest_lines(self, versions: DataFrame) -> DataFrame:
        falling = (
            "l_shipdate",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
            "l_tax",
            "l_discount",
        )
        newest = first_by(
            versions,
            ["order_line_id"],
            [F.col(c).desc() for c in falling] + [F.col("l_returnflag"), F.col("l_linestatus")],
        )
        return newest.select(
            "order_line_id",
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("p_retailprice").cast("decimal(9,2)").alias("unit_price"),
            (F.col("l_discount").cast("decimal(5,2)") * 100)
            .cast("decimal(5,2)")
            .alias("discount_pct"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
            "l_returnflag",
            "l_linestatus",
        )

    @cached_property
    def line_parts(self) -> int | None:
        """Partitions for joins of the lines, so that a task meets so many of them however large the table is.

        None while the cores are enough; adaptive execution then chooses. Only
        counted, which the files' footers answer.
        """
        parts = math.ceil(self.raw("lineitem").count() / LINES_PER_TASK)
        return parts if parts > self.spark.sparkContext.defaultParallelism else None

    @cached_property
    def deliveries(self) -> DataFrame:
        shift = (F.col("order_line_id") % 6 - 1).cast("int")
        is_open = (F.col("l_linestatus") == "O") & (F.col("order_line_id") % 4 == 0)
        return self.lines.select(
            F.col("order_line_id").alias("delivery_id"),
            "order_id",
            F.col("ship_date").alias("planned_date"),
            F.when(~is_open, F.date_add("ship_date", shift)).alias("actual_date"),
            F.col("l_returnflag").alias("carrier"),
        )

    @cached_property
    def shipments(self) -> DataFrame:
        return self.lines.join(
            self.raw("supplier").select("s_suppkey", "s_name"),
            F.col("supplier_id") == F.col("s_suppkey"),
        ).select(
            F.col("order_line_id").alias("shipment_id"),
            "order_id",
            F.col("s_name").alias("distributor"),
            "ship_date",
            F.col("quantity").alias("qty_cases"),
            F.concat("l_returnflag", "l_linestatus").alias("warehouse"),
        )

    @cached_property
    def returns(self) -> DataFrame:
        return self.lines.where("l_returnflag = 'R'").select(
            F.col("order_line_id").alias("return_id"),
            "order_id",
            F.concat(F.lit("SKU-"), F.col("product_id")).alias("product_sku"),
            F.col("ship_date").alias("return_date"),
            "quantity",
            F.col("l_linestatus").alias("reason"),
        )

    @cached_property
    def segment_versions(self) -> DataFrame:
        """Every order states the segment its customer had at that moment."""
        return self.raw("orders").select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderpriority").alias("segment"),
            F.col("o_orderdate").alias("modified_at"),
            F.col("o_orderkey").alias("seq"),
        )

    @cached_property
    def segment_history(self) -> DataFrame:
        return full_history(
            self.segment_versions, "customer_id", "modified_at", ["segment"], ["seq"]
        )

    @cached_property
    def customer_history(self) -> DataFrame:
        """Customer attributes with the segment in its historical versions."""
        return self.customers.drop("segment").join(self.segment_history, "customer_id")

    @cached_property
    def runs(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").alias("run_id"),
            F.col("event_type").alias("task"),
            F.when(F.col("event_type") == "error", "failed").otherwise("succeeded").alias("status"),
            F.col("ts").alias("started_at"),
            F.col("ts").alias("finished_at"),
            F.col("props").alias("message"),
            "value",
        )

    @cached_property
    def jobs(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_custkey").alias("job_id"),
            F.col("o_orderpriority").alias("name"),
            F.col("o_orderdate").alias("change_time"),
            F.col("o_orderkey").alias("seq"),
        )

    @cached_property
    def usage(self) -> DataFrame:
        return self.lines.select(
            F.col("order_line_id").alias("usage_id"),
            # Some usage has no product, some has not ended, and quantities are fractions.
            F.when(F.col("order_line_id") % 89 != 0, F.col("l_returnflag")).alias("sku_name"),
            F.col("l_linestatus").alias("cloud"),
            F.col("ship_date").alias("usage_date"),
            F.when(F.col("order_line_id") % 97 != 0, F.col("ship_date")).alias("usage_end"),
            (F.col("quantity") * F.lit(Decimal("0.25"))).cast("decimal(12,2)").alias("usage_quantity"),
            F.col("supplier_id").alias("variant"),
            F.col("order_id").alias("job_run_id"),
        )

    @cached_property
    def prices(self) -> DataFrame:
        year = F.year("ship_date").alias("price_year")
        starts = (
            self.lines.where(F.year("ship_date") >= 1996)
            .groupBy(F.col("l_returnflag").alias("sku_name"), F.col("l_linestatus").alias("cloud"), year)
            .agg(F.min("ship_date").alias("price_start"))
        )
        # One row per product, cloud and year: the next price starts in a later year.
        following = Window.partitionBy("sku_name", "cloud").orderBy("price_year")
        return starts.select(
            "sku_name",
            "cloud",
            "price_year",
            "price_start",
            F.lead("price_start").over(following).alias("price_end"),
            (F.col("price_year") - 1990).cast("decimal(9,2)").alias("price"),
        )
