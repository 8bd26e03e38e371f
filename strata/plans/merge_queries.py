"""Queries over merges, history, change feeds, marks and table versions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import moment
from strata.functions.skew import hot_keys
from strata.operators import conform, history, merge, snapshots, star
from strata.operators.snapshots import SnapshotTable
from strata.plans.registry import query
from strata.plans.staging import Staging
from strata.plans.star_queries import row_counts
from strata.session import work_folder
from strata.sources.increments import since, stamp_load

FIRST_LOAD = "timestamp_ntz '1998-01-01'"
SECOND_LOAD = "timestamp_ntz '2000-01-01'"
AT = [datetime(2024, 1, d) for d in range(1, 11)]


def segment_batch(s: Staging, condition: str) -> DataFrame:
    return conform.newest_version(s.segment_versions.where(condition), "customer_id")


def first_history(s: Staging) -> DataFrame:
    return history.open_versions(segment_batch(s, f"modified_at < {FIRST_LOAD}"))


def second_batch(s: Staging) -> DataFrame:
    return segment_batch(s, f"modified_at >= {FIRST_LOAD}")


@query
def scd2_initial(s: Staging) -> DataFrame:
    return first_history(s)


@query
def scd2_apply_batch(s: Staging) -> DataFrame:
    return history.scd2_state(first_history(s), second_batch(s), "customer_id", ["segment"])


@query
def scd2_full_history(s: Staging) -> DataFrame:
    return s.segment_history


@query
def scd2_full_history_hot(s: Staging) -> DataFrame:
    """The same history with customers of over a thousandth of the rows cut into pieces."""
    hot = hot_keys(s.segment_versions, ["customer_id"], share=1e-3, floor=0)
    return history.full_history(
        s.segment_versions, "customer_id", "modified_at", ["segment"], ["seq"], hot=hot
    )


@query
def scd2_key_proof(s: Staging) -> DataFrame:
    """Per key after a batch: versions, current ones, closed ones, what is current."""
    after = history.scd2_state(first_history(s), second_batch(s), "customer_id", ["segment"])
    return after.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("is_current").alias("current_rows"),
        F.count_if(~F.col("is_current") & F.col("valid_to").isNotNull()).alias("closed_rows"),
        F.max(F.when(F.col("is_current"), F.col("segment"))).alias("current_segment"),
    )


def orders_before(s: Staging) -> DataFrame:
    """Orders as first recorded: everything still open."""
    early = s.orders.where(f"modified_at < {SECOND_LOAD}")
    return early.withColumn("status", F.lit("placed"))


def orders_update(s: Staging) -> DataFrame:
    """A later extract that overlaps the first load by two years."""
    return s.orders.where(f"modified_at >= {FIRST_LOAD}")


@query
def upsert_orders(s: Staging) -> DataFrame:
    return merge.upsert_state(orders_before(s), orders_update(s), "order_id")


@query
def upsert_change_counts(s: Staging) -> DataFrame:
    return merge.count_ops(merge.upsert_changes(orders_before(s), orders_update(s), "order_id"))


@query
def silver_rows_changed(s: Staging) -> DataFrame:
    """Changed rows over all entities of a run, and whether gold must follow."""
    orders = merge.upsert_changes(orders_before(s), orders_update(s), "order_id")
    customers = history.scd2_changes(
        first_history(s), second_batch(s), "customer_id", ["segment"]
    )
    replay = merge.upsert_changes(s.returns, s.returns, "return_id")
    total = None
    for changes in (orders, customers, replay):
        one = changes.agg(F.count(F.lit(1)).alias("_n"))
        total = one if total is None else total.unionByName(one)
    return total.agg(F.sum("_n").alias("rows_changed")).withColumn(
        "refresh_gold", F.col("rows_changed") > 0
    )


@query
def change_feed(s: Staging) -> DataFrame:
    return merge.change_feed(orders_before(s), upsert_orders(s), "order_id")


@query
def change_feed_recent(s: Staging) -> DataFrame:
    loaded = orders_before(s)
    first = loaded.select(
        F.lit("insert").alias("_change_type"), "*", F.lit(0).cast("bigint").alias("_commit_version")
    )
    second = change_feed(s).withColumn("_commit_version", F.lit(1).cast("bigint"))
    columns = ["_change_type", "_commit_version", "order_id", "status", "modified_at"]
    return merge.recent_changes(first.unionByName(second), "order_id").select(*columns)


def recorded_orders(s: Staging) -> SnapshotTable:
    """Orders over five versions: loaded, merged, edited, purged, and merged again."""
    table = SnapshotTable(s.spark, work_folder(s.spark, "orders"), "order_id", 16)
    table.upsert(orders_before(s), at=AT[0])
    table.upsert(orders_update(s), at=AT[1])
    table.update_where("status = 'shipped' and channel = 'direct'", {"status": "'delivered'"}, at=AT[2])
    table.delete_where("status = 'cancelled'", at=AT[3])
    # What was cancelled since 1998 comes back with its last state, the rest of the extract changes only what was edited.
    table.upsert(orders_update(s), at=AT[4])
    return table


@query
def change_feed_range(s: Staging) -> DataFrame:
    """Every commit's changes since version 0, newest first where it is listed."""
    feed = recorded_orders(s).changes(0)
    return feed.withColumn("_commit_timestamp", F.col("_commit_timestamp").cast("timestamp_ntz"))


@query
def change_feed_per_commit(s: Staging) -> DataFrame:
    """Rows by kind of change for the versions from 2 on, from one pass over their images."""
    feed = recorded_orders(s).changes(2)
    return feed.groupBy("_commit_version", "_change_type").agg(F.count(F.lit(1)).alias("changes"), F.countDistinct("order_id").alias("orders"))


@query
def bronze_merge_versions(s: Staging) -> DataFrame:
    """Two overlapping increments; every (line, ship date) is kept once."""
    rows = s.line_versions.drop("p_partkey", "p_retailprice")
    keys = ["order_line_id", "l_shipdate"]
    one = rows.where(f"l_shipdate < {SECOND_LOAD}")
    two = rows.where(f"l_shipdate >= {FIRST_LOAD}")
    loaded = merge.unseen_versions(one.limit(0), one, keys)
    return loaded.unionByName(merge.unseen_versions(loaded, two, keys))


@query
def silver_entity_counts(s: Staging) -> DataFrame:
    return row_counts(
        {
            "customers": segment_batch(s, "true"),
            "products": s.products,
            "orders": upsert_orders(s),
            "order_lines": s.lines,
            "deliveries": s.deliveries,
            "shipments": s.shipments,
            "returns": s.returns,
        }
    )


def channel_feeds(s: Staging) -> DataFrame:
    """Orders as one feed per channel."""
    return s.orders.select(F.col("channel").alias("source"), "modified_at")


def first_marks(s: Staging) -> DataFrame:
    """Marks after the first load; one channel was never read."""
    seen = channel_feeds(s).where(f"modified_at < {FIRST_LOAD} and source <> 'online'")
    return (
        seen.groupBy("source")
        .agg(F.max("modified_at").alias("watermark"))
        .withColumn("updated_at", moment(AT[0], T.TimestampNTZType()))
    )


@query
def watermark_read(s: Staging) -> DataFrame:
    sources = channel_feeds(s).select("source").distinct()
    return merge.marks_for(sources, first_marks(s))


@query
def watermark_advance(s: Staging) -> DataFrame:
    fresh = channel_feeds(s).where(
        f"modified_at >= {FIRST_LOAD} and source <> 'direct'"
    )
    return merge.advanced_marks(first_marks(s), fresh, moment(AT[1], T.TimestampNTZType()))


@query
def src_incremental(s: Staging) -> DataFrame:
    return since(s.orders, "modified_at", datetime(1999, 6, 1))


@query
def load_metadata(s: Staging) -> DataFrame:
    return stamp_load(s.orders, "orders").drop("_ingest_ts")


# -- table versions ------------------------------------------------------


def returns_table(s: Staging, buckets: int = 8) -> SnapshotTable:
    path = work_folder(s.spark, "versions")
    table = SnapshotTable(s.spark, path, "return_id", buckets)
    table.overwrite(s.returns, at=AT[0])
    return table


@query
def gold_rebuild_idempotent(s: Staging) -> DataFrame:
    """The SLA aggregate published twice from the same input."""
    table = SnapshotTable(s.spark, work_folder(s.spark, "rebuild"), "planned_date")
    for moment in AT[:2]:
        table.overwrite(star.delivery_sla(s.deliveries), at=moment)
    return table.read()


@query
def update_where(s: Staging) -> DataFrame:
    table = returns_table(s)
    table.update_where("reason = 'O'", {"quantity": "quantity + 1"}, at=AT[1])
    return table.read()


@query
def delete_where(s: Staging) -> DataFrame:
    table = returns_table(s)
    table.delete_where("nullif(quantity, 13) > 40", at=AT[1])
    return table.read()


def edited_table(s: Staging) -> SnapshotTable:
    table = returns_table(s)
    table.update_where("reason = 'O'", {"quantity": "quantity + 1"}, at=AT[1])
    table.delete_where("return_date >= date '2001-01-01'", at=AT[2])
    table.compact(at=AT[3])
    return table


@query
def read_version(s: Staging) -> DataFrame:
    return edited_table(s).read(1)


@query
def version_diff(s: Staging) -> DataFrame:
    """Rows and quantity in the first version against the newest."""
    table = edited_table(s)
    sides = []
    for label, rows in (("first", table.read(0)), ("latest", table.read())):
        sides.append(
            rows.agg(
                F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("total_quantity")
            ).select(F.lit(label).alias("side"), "row_count", "total_quantity")
        )
    both = sides[0].unionByName(sides[1])
    first, last = (
        lambda c: F.max(F.when(F.col("side") == "first", F.col(c))),
        lambda c: F.max(F.when(F.col("side") == "latest", F.col(c))),
    )
    return both.agg(
        first("row_count").alias("rows_first"),
        last("row_count").alias("rows_latest"),
        (first("row_count") - last("row_count")).alias("rows_removed"),
        (first("total_quantity") - last("total_quantity")).alias("quantity_removed"),
    )


@query
def restore_version(s: Staging) -> DataFrame:
    table = edited_table(s)
    table.restore(1, at=AT[4])
    return table.read()


@query
def version_history(s: Staging) -> DataFrame:
    """Row changes per version, from the feeds of neighbouring versions."""
    table = edited_table(s)
    feeds = None
    for newer in (1, 2, 3):
        feed = table.changes_between(newer - 1, newer).select("_change_type", "_commit_version")
        feeds = feed if feeds is None else feeds.unionByName(feed)
    kinds = F.col("_change_type")
    measured = feeds.groupBy("_commit_version").agg(
        F.count_if(kinds == "update_postimage").alias("rows_updated"),
        F.count_if(kinds == "delete").alias("rows_deleted"),
    )
    commits = table.commits().select("version", "operation", "updated", "deleted")
    zero = F.lit(0).cast("bigint")
    return commits.join(
        measured, F.col("version") == F.col("_commit_version"), "left"
    ).select(
        "version",
        "operation",
        "updated",
        "deleted",
        F.coalesce("rows_updated", zero).alias("rows_updated"),
        F.coalesce("rows_deleted", zero).alias("rows_deleted"),
    )


@query
def retention_candidates(s: Staging) -> DataFrame:
    table = edited_table(s)
    found = snapshots.retention_candidates(table.commits(), datetime(2024, 1, 10, 12), 168)
    return found.withColumn("replaced_at", F.col("replaced_at").cast("timestamp_ntz"))
