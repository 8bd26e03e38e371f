"""Queries over file drops taken in by a stream."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.plans.lake import RETURNS, SHIPMENTS
from strata.plans.registry import query
from strata.plans.staging import Staging
from strata.session import work_folder
from strata.sources.generate import write_drop
from strata.streaming.drops import Feed, exposed, land, landed, nested, typed

CUTS = (date(1997, 1, 1), date(1999, 6, 1))


def in_three(rows: DataFrame, day: str) -> list[DataFrame]:
    first, second = (F.lit(c) for c in CUTS)
    at = F.col(day)
    return [
        rows.where(at < first),
        rows.where((at >= first) & (at < second)),
        rows.where(at >= second),
    ]


def landed_in_steps(s: Staging, feed: Feed, drops: list[DataFrame]) -> DataFrame:
    """First drop, run, remaining drops, run, then a run without new files."""
    base = work_folder(s.spark, feed.name)
    target, checkpoint = f"{base}/table", f"{base}/checkpoint"
    total = 0
    for step in ([0], range(1, len(drops)), []):
        for n in step:
            write_drop(drops[n], feed.kind, f"{base}/landing/drop-{n + 1}")
        total += land(s.spark, feed, f"{base}/landing", target, checkpoint)
    return landed(s.spark, feed, target)


def business(rows: DataFrame, feed: Feed) -> DataFrame:
    return rows.select(*feed.types)


@query
def stream_csv_ingest(s: Staging) -> DataFrame:
    drops = in_three(s.shipments, "ship_date")
    return business(typed(landed_in_steps(s, SHIPMENTS, drops), SHIPMENTS), SHIPMENTS)


@query
def stream_json_ingest(s: Staging) -> DataFrame:
    drops = in_three(s.returns, "return_date")
    return business(typed(landed_in_steps(s, RETURNS, drops), RETURNS), RETURNS)


@query
def stream_evolved_columns(s: Staging) -> DataFrame:
    """Later drops bring a new column, in front of reordered old ones."""
    first, *later = in_three(s.shipments, "ship_date")
    columns = [c for c in reversed(s.shipments.columns)]
    priority = (F.col("qty_cases") % 3).alias("priority")
    grown = [d.select(priority, *columns) for d in later]
    rows = landed_in_steps(s, SHIPMENTS, [first, *grown])
    return typed_with(exposed(rows, "priority"), "priority", "int")


def typed_with(rows: DataFrame, name: str, kind: str) -> DataFrame:
    wider = Feed(SHIPMENTS.name, SHIPMENTS.kind, {**SHIPMENTS.types, name: kind})
    return business(typed(rows, wider), wider)


@query
def stream_nested_columns(s: Staging) -> DataFrame:
    """Later drops bring a nested field, of which the last one changes a member's type."""
    first, second, third = in_three(s.returns, "return_date")
    carrier = F.concat(F.lit("C"), F.col("quantity") % 3).alias("carrier")
    weight = F.col("quantity") * 2
    as_text = F.when(F.col("quantity") > 40, F.lit("heavy")).otherwise(weight.cast("string"))
    second = second.withColumn("details", F.struct(carrier, weight.alias("weight")))
    third = third.withColumn("details", F.struct(as_text.alias("weight"), F.array(F.lit(1)).alias("more"), carrier))
    fields = {"details_carrier": ("$.carrier", "string"), "details_weight": ("$.weight", "int")}
    rows = nested(landed_in_steps(s, RETURNS, [first, second, third]), "details", fields)
    wider = Feed(RETURNS.name, RETURNS.kind, {**RETURNS.types, **{c: kind for c, (_, kind) in fields.items()}, "details_rescued": "string"})
    return business(typed(rows, wider), wider)


@query
def rescued_rows(s: Staging) -> DataFrame:
    """Values that do not fit their type and fields nobody declared are kept as JSON."""
    broken = s.returns.select(
        "return_id",
        "order_id",
        F.concat(F.lit("00"), F.col("order_id")).alias("product_sku"),
        "return_date",
        F.when(F.col("quantity") > 40, F.lit("many"))
        .otherwise(F.col("quantity").cast("string"))
        .alias("quantity"),
        "reason",
        F.when(F.col("reason") == "O", F.lit("late")).alias("remark"),
    )
    rows = landed_in_steps(s, RETURNS, [broken])
    return typed(rows, RETURNS).select(*RETURNS.types, "_rescued_data")


@query
def rows_per_source_file(s: Staging) -> DataFrame:
    """Rows per drop folder, from the file each row came from."""
    rows = landed_in_steps(s, SHIPMENTS, in_three(s.shipments, "ship_date"))
    drop = F.regexp_extract("_source_file", r"/(drop-\d+)/", 1).alias("drop_name")
    stamped = F.count_if(F.col("_ingest_ts").isNotNull()).alias("stamped")
    return rows.groupBy(drop).agg(F.count(F.lit(1)).alias("row_count"), stamped)
