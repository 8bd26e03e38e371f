"""Queries over the performance lab, generated data and layouts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import conform, lab, layout
from strata.plans.registry import query
from strata.plans.staging import Staging
from strata.session import work_folder
from strata.sources import generate

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
COLD_SUPPLIER = 3
WINDOW = date(1998, 3, 1), date(1998, 3, 30)
MONTH = date(1998, 3, 1), date(1998, 3, 31)
HALF_YEAR = date(1998, 1, 1), date(1998, 6, 30)


def line_sales(s: Staging) -> DataFrame:
    """Lines as sales. The date keeps its stored type, so filters reach the scan."""
    return s.raw("lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("sale_id"),
        F.col("l_shipdate").alias("sale_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_returnflag").alias("region"),
        F.col("l_linestatus").alias("channel"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("revenue"),
    )


def order_sales(s: Staging) -> DataFrame:
    """Orders as sales with a unique id; the priority stands for the region."""
    return s.raw("orders").select(
        F.col("o_orderkey").alias("sale_id"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("region"),
        F.col("o_orderstatus").alias("channel"),
        F.lit(1).alias("quantity"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("revenue"),
    )


def promotion_calendar(s: Staging, regions: DataFrame, width: int) -> DataFrame:
    """Promotions for every week the orders span."""
    span = s.raw("orders").agg(
        F.min("o_orderdate").cast("date").alias("_first"),
        F.max("o_orderdate").cast("date").alias("_last"),
    )
    first = span.select("_first").scalar()
    weeks = F.floor(F.datediff(span.select("_last").scalar(), first) / 7).cast("int") + 1
    return generate.promotions(regions, first, weeks, width)


def lab_promotions(s: Staging) -> DataFrame:
    return promotion_calendar(s, generate.region_list(s.spark, PRIORITIES), len(PRIORITIES))


def brands(s: Staging) -> DataFrame:
    return s.raw("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
    )


def buyer_segments(s: Staging) -> DataFrame:
    return s.raw("customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("brand")
    )


@query
def lab_selective_window(s: Staging) -> DataFrame:
    return lab.selective_window(line_sales(s), "supplier_id", COLD_SUPPLIER, *WINDOW)


@query
def lab_single_day(s: Staging) -> DataFrame:
    return lab.single_day(line_sales(s), date(1998, 6, 15))


@query
def lab_full_scan(s: Staging) -> DataFrame:
    return lab.full_scan(line_sales(s))


@query
def lab_hot_key(s: Staging) -> DataFrame:
    sales = line_sales(s)
    return lab.hot_key_total(sales, "product_id", lab.most_frequent(sales, "product_id").scalar())


@query
def lab_exploding_bad(s: Staging) -> DataFrame:
    return lab.promoted_distinct(order_sales(s), lab_promotions(s), *MONTH)


@query
def lab_exploding_rewritten(s: Staging) -> DataFrame:
    return lab.promoted(order_sales(s), lab_promotions(s), *MONTH)


@query
def lab_nonsargable_bad(s: Staging) -> DataFrame:
    return lab.month_by_functions(line_sales(s), 1998, 6)


@query
def lab_nonsargable_rewritten(s: Staging) -> DataFrame:
    return lab.month_by_range(line_sales(s), 1998, 6)


@query
def lab_distinct_bad(s: Staging) -> DataFrame:
    found = lab.labelled(order_sales(s), buyer_segments(s), "customer_id", *HALF_YEAR)
    return found.distinct()


@query
def lab_distinct_rewritten(s: Staging) -> DataFrame:
    return lab.labelled(order_sales(s), buyer_segments(s), "customer_id", *HALF_YEAR)


@query
def lab_dim_join_shuffle(s: Staging) -> DataFrame:
    return lab.brand_by_shuffle(line_sales(s), brands(s), "product_id")


@query
def lab_dim_join_broadcast(s: Staging) -> DataFrame:
    return lab.brand_by_broadcast(line_sales(s), brands(s), "product_id")


@query
def lab_skew_join(s: Staging) -> DataFrame:
    return lab.segment_join(line_sales(s), brands(s), "product_id", ["category"])


@query
def lab_skew_join_salted(s: Staging) -> DataFrame:
    return lab.segment_join_salted(
        line_sales(s), brands(s), "product_id", ["category"], share=5e-4, floor=0, salts=16
    )


@query
def lab_scan_two_keys(s: Staging) -> DataFrame:
    return lab.scan_by_two_keys(line_sales(s))


@query
def lab_skew_two_keys(s: Staging) -> DataFrame:
    return lab.segment_join(line_sales(s), brands(s), "product_id", ["category", "brand"])


@query
def lab_selective_open(s: Staging) -> DataFrame:
    return lab.selective_open(line_sales(s), "supplier_id", COLD_SUPPLIER, date(1998, 1, 1))


# -- generated data, keyed by the given tables -----------------------------


def generated_sales(s: Staging) -> DataFrame:
    return generate.sales(s.lines.select(F.col("order_line_id").alias("sale_id")))


@query
def gen_sales(s: Staging) -> DataFrame:
    return generated_sales(s)


@query
def gen_sales_profile(s: Staging) -> DataFrame:
    """Shape of the generated fact: skew, spans and totals per region and channel."""
    return generated_sales(s).groupBy("region", "channel").agg(
        F.count(F.lit(1)).alias("sales"),
        F.count_if(F.col("customer_id") == generate.HOT_CUSTOMER).alias("hot_sales"),
        F.countDistinct("order_ref").alias("refs"),
        F.min("sale_date").alias("first_day"),
        F.max("sale_date").alias("last_day"),
        F.sum("quantity").alias("quantity"),
        F.sum("revenue").cast("decimal(18,2)").alias("revenue"),
    )


@query
def gen_customers_profile(s: Staging) -> DataFrame:
    made = generate.customers(s.raw("customer").select(F.col("c_custkey").alias("customer_id")))
    return made.groupBy("region", "segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.countDistinct("customer_name").alias("names"),
        F.sum("credit_limit").alias("credit_limit"),
    )


@query
def gen_products_profile(s: Staging) -> DataFrame:
    made = generate.products(s.raw("part").select(F.col("p_partkey").alias("product_id")))
    return made.groupBy("brand", "category").agg(
        F.count(F.lit(1)).alias("products"), F.countDistinct("product_name").alias("names")
    )


@query
def gen_promotions(s: Staging) -> DataFrame:
    regions = s.raw("region").select(
        F.col("r_regionkey").alias("position"), F.col("r_name").alias("region")
    )
    return promotion_calendar(s, regions, len(generate.REGIONS)).drop("discount")


def drop_keys(s: Staging) -> DataFrame:
    """Every order is the key of a row of its day's drop."""
    return s.raw("orders").select(
        F.col("o_orderkey").alias("key"),
        F.col("o_orderkey").alias("number"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


@query
def gen_returns_profile(s: Staging) -> DataFrame:
    """A drop with one return per order, profiled per product and reason."""
    return generate.drop_returns(drop_keys(s), 2).groupBy("product_sku", "reason").agg(
        F.count(F.lit(1)).alias("returns"),
        F.sum("quantity").alias("quantity"),
        F.min("return_date").alias("first_day"),
        F.max("return_date").alias("last_day"),
        F.max("return_id").alias("last_id"),
    )


@query
def gen_drops_profile(s: Staging) -> DataFrame:
    """A drop with one shipment per order, profiled per distributor and warehouse."""
    return generate.drop_shipments(drop_keys(s)).groupBy("distributor", "warehouse").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum("qty_cases").alias("cases"),
        F.min("ship_date").alias("first_day"),
        F.max("ship_date").alias("last_day"),
        F.max("shipment_id").alias("last_id"),
    )


@query
def gen_key_coverage(s: Staging) -> DataFrame:
    """Generated facts without a generated customer or product: none."""
    facts = generated_sales(s)
    lost = conform.orphan_count(
        facts, generate.all_customers(s.spark), "customer_id", "orphans"
    ).withColumn("dimension", F.lit("customers"))
    other = conform.orphan_count(
        facts, generate.all_products(s.spark), "product_id", "orphans"
    ).withColumn("dimension", F.lit("products"))
    return lost.unionByName(other)


# -- layouts ---------------------------------------------------------------

KEYS = ["product_id", "ship_date"]
BOX = {"product_id": (100, 110), "ship_date": WINDOW}
SMALL_TARGET = 256 * 1024
SMALL_FILES = 32


def layout_rows(s: Staging) -> DataFrame:
    return s.lines


def written(s: Staging, write: Callable[[DataFrame, str], object]) -> DataFrame:
    path = work_folder(s.spark, "layout")
    write(layout_rows(s), path)
    return s.spark.read.parquet(path)


def small(s: Staging, path: str) -> str:
    layout.write_small_files(layout_rows(s), path, 32)
    return path


@query
def layout_smallfiles(s: Staging) -> DataFrame:
    return written(s, lambda rows, path: layout.write_small_files(rows, path, 32))


@query
def layout_compacted(s: Staging) -> DataFrame:
    source, path = small(s, work_folder(s.spark, "small")), work_folder(s.spark, "compact")
    layout.compact(s.spark, source, path)
    return s.spark.read.parquet(path)


@query
def layout_zorder(s: Staging) -> DataFrame:
    return written(s, lambda rows, path: layout.write_zorder(rows, path, KEYS))


@query
def layout_kd(s: Staging) -> DataFrame:
    """Boxes of nearly as many rows, as many as the data fills files."""
    source = small(s, work_folder(s.spark, "small"))
    files = layout.files_for(s.spark, source, SMALL_TARGET)
    return written(s, lambda rows, path: layout.write_kd(rows, path, KEYS, files))


@query
def layout_clustered(s: Staging) -> DataFrame:
    """Clustered table that receives a second batch in its declared order."""
    path = work_folder(s.spark, "clustered")
    early = F.col("ship_date") < F.lit(date(2000, 1, 1))
    layout.write_clustered(layout_rows(s).where(early), path, KEYS)
    layout.append_clustered(s.spark, layout_rows(s).where(~early), path)
    return s.spark.read.parquet(path)


@query
def layout_partitioned(s: Staging) -> DataFrame:
    by_day = written(s, lambda rows, path: layout.write_partitioned(rows, path, "ship_date"))
    return by_day.select(*layout_rows(s).columns)


def variants(s: Staging) -> dict[str, DataFrame]:
    """The same rows under every layout."""
    base = work_folder(s.spark, "variants")
    rows = s.lines_dealt(layout.parts_for(s.spark, SMALL_FILES))
    paths = layout.write_variants(rows, base, KEYS, "ship_date", SMALL_FILES, SMALL_TARGET, dealt=True)
    return {name: s.spark.read.parquet(path) for name, path in paths.items()}


def _labelled(reports: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, rows in reports.items():
        one = rows.withColumn("layout", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query
def layout_file_stats(s: Staging) -> DataFrame:
    return _labelled(
        {
            name: layout.table_stats(table, ["ship_date"] if name == "partitioned" else [])
            for name, table in variants(s).items()
        }
    )


@query
def layout_skippable_files(s: Staging) -> DataFrame:
    return _labelled(
        {name: layout.skippable_files(table, BOX) for name, table in variants(s).items()}
    )


@query
def layout_pruned_rows(s: Staging) -> DataFrame:
    """Rows of each layout by the sizes of its files, and those of a box through the files that can hold them."""
    reports = {}
    for name, table in variants(s).items():
        found = layout.pruned(table, BOX).agg(
            F.count(F.lit(1)).alias("wanted_rows"),
            F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("wanted_quantity"),
        )
        reports[name] = layout.table_stats(table).select("row_count").join(found)  # one row each
    return _labelled(reports)
