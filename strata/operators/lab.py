"""Query pairs of the performance lab: a costly form and its rewrite.

The functions take a sales table with ``sale_id, sale_date, region, channel,
quantity, revenue`` and the dimension keys they join on.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import money, within_month
from strata.functions.skew import hot_keys, salted_join



def _revenue() -> Column:
    return money(F.sum("revenue")).alias("revenue")


def _volume() -> tuple[Column, Column]:
    return F.count(F.lit(1)).alias("sales"), _revenue()


def selective_window(sales: DataFrame, key: str, value: int, first: date, last: date) -> DataFrame:
    wanted = (F.col(key) == value) & F.col("sale_date").between(F.lit(first), F.lit(last))
    return sales.where(wanted).groupBy("sale_date").agg(_revenue())


def single_day(sales: DataFrame, day: date) -> DataFrame:
    return sales.where(F.col("sale_date") == F.lit(day)).groupBy("channel").agg(*_volume())


def full_scan(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region").agg(*_volume())


def most_frequent(sales: DataFrame, key: str) -> DataFrame:
    """The key with most rows, the smallest one among equals."""
    sizes = sales.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    return sizes.orderBy(F.col("_size").desc(), key).limit(1).select(key)


def hot_key_total(sales: DataFrame, key: str, value: Column | int) -> DataFrame:
    """Totals of one key; a plain value is pushed down to the scan."""
    return sales.where(F.col(key) == value).agg(*_volume())


def promoted_distinct(
    sales: DataFrame, promotions: DataFrame, first: date, last: date
) -> DataFrame:
    """Costly form: region join with the dates checked on top, then DISTINCT."""
    pairs = sales.join(promotions, "region").where(
        F.col("sale_date").between(F.lit(first), F.lit(last))
        & F.col("sale_date").between(F.col("promo_start"), F.col("promo_end"))
    )
    return pairs.select("sale_id", "revenue", "promo_id").distinct()


def promoted(sales: DataFrame, promotions: DataFrame, first: date, last: date) -> DataFrame:
    """Rewrite: a promotion becomes one row per day it covers, and the join an
    equality on region and day. A sale meets only its own promotions, rows spread
    over all region days instead of the few regions, and nothing repeats."""
    begin = F.greatest("promo_start", F.lit(first))
    end = F.least("promo_end", F.lit(last))
    days = promotions.where(begin <= end).select(
        "promo_id", "region", F.explode(F.sequence(begin, end)).alias("sale_date")
    )
    recent = sales.where(F.col("sale_date").between(F.lit(first), F.lit(last)))
    return recent.join(days, ["region", "sale_date"]).select("sale_id", "revenue", "promo_id")


def month_by_functions(sales: DataFrame, year: int, month: int) -> DataFrame:
    """Costly form: functions around the date hide it from scan statistics."""
    wanted = (F.year("sale_date") == year) & (F.month("sale_date") == month)
    return sales.where(wanted).groupBy("channel").agg(*_volume())


def month_by_range(sales: DataFrame, year: int, month: int) -> DataFrame:
    """Rewrite: a date range the scan can push down."""
    wanted = within_month("sale_date", year, month)
    return sales.where(wanted).groupBy("channel").agg(*_volume())


def labelled(sales: DataFrame, dimension: DataFrame, key: str, first: date, last: date):
    """Sales of a period with a dimension attribute; ``sale_id`` stays unique."""
    recent = sales.where(F.col("sale_date").between(F.lit(first), F.lit(last)))
    return recent.join(dimension, key).select("sale_id", "quantity", "revenue", "brand")


def brand_by_shuffle(sales: DataFrame, products: DataFrame, key: str) -> DataFrame:
    joined = sales.join(products.hint("merge"), key)
    return joined.groupBy("brand").agg(_revenue())


def brand_by_broadcast(sales: DataFrame, products: DataFrame, key: str) -> DataFrame:
    """The dimension is cut to what is asked; the planner broadcasts it while its bytes allow."""
    return sales.join(products.select(key, "brand"), key).groupBy("brand").agg(_revenue())


def segment_join_shuffled(sales: DataFrame, dimension: DataFrame, key: str, by: list[str]):
    """Costly form: a shuffle join of all rows on a skewed key, whose partition
    adaptive execution splits."""
    return sales.join(dimension.hint("merge"), key).groupBy(*by).agg(*_volume())


def segment_join(sales: DataFrame, dimension: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Rewrite: sales are summed per key before they meet the dimension.

    Map tasks combine a hot key into one row each, so neither the skew nor the
    size of the sales reaches the join. All sales of a key meet the same
    dimension rows, hence the totals per ``by`` (dimension columns) are equal.
    """
    per_key = sales.groupBy(key).agg(
        F.count(F.lit(1)).alias("_sales"), F.sum("revenue").alias("_revenue")
    )
    return (
        per_key.join(dimension, key)
        .groupBy(*by)
        .agg(F.sum("_sales").alias("sales"), money(F.sum("_revenue")).alias("revenue"))
    )


def segment_join_salted(
    sales: DataFrame,
    dimension: DataFrame,
    key: str,
    by: list[str],
    share: float,
    floor: int,
    salts: int = 64,
) -> DataFrame:
    """The same with the hot keys spread by hand, for sessions without adaptive
    execution or where the join feeds an operator that forbids its splitting."""
    hot = hot_keys(sales, [key], share, floor)
    joined = salted_join(sales, dimension, key, ["sale_id"], hot, salts=salts)
    return joined.groupBy(*by).agg(*_volume())


def scan_by_two_keys(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region", "channel").agg(
        *_volume(), F.avg("quantity").alias("avg_quantity")
    )


def selective_open(sales: DataFrame, key: str, value: int, first: date) -> DataFrame:
    wanted = (F.col(key) == value) & (F.col("sale_date") >= F.lit(first))
    return sales.where(wanted).groupBy("sale_date").agg(_revenue())
