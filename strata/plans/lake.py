"""The pipeline: bronze intake, silver conformance, gated gold, run log."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from datetime import UTC, datetime
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import conform, gates, star
from strata.operators.merge import NEVER_READ
from strata.operators.rows import touched_rows
from strata.operators.runs import RUN_SCHEMA, AppendLog, log_run
from strata.operators.snapshots import SnapshotTable, Staged
from strata.session import extracted
from strata.sources.increments import MODIFIED, stamp_load
from strata.streaming.drops import Feed, land, landed, typed

# Database entities and file feeds with their business keys.
ENTITIES = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_lines": "order_line_id",
    "deliveries": "delivery_id",
}
SHIPMENTS = Feed(
    "shipments",
    "csv",
    {
        "shipment_id": "bigint",
        "order_id": "int",
        "distributor": "string",
        "ship_date": "date",
        "qty_cases": "int",
        "warehouse": "string",
    },
)
RETURNS = Feed(
    "returns",
    "json",
    {
        "return_id": "bigint",
        "order_id": "int",
        "product_sku": "string",
        "return_date": "date",
        "quantity": "int",
        "reason": "string",
    },
)
FEEDS = {"shipments": (SHIPMENTS, "shipment_id"), "returns": (RETURNS, "return_id")}
GOLD_KEYS = {
    "dim_customer": "customer_id",
    "dim_product": "product_id",
    "dim_date": "date",
    "fact_sales": "order_line_id",
    "agg_daily_revenue": "order_date",
    "agg_delivery_sla": "planned_date",
    "agg_distributor_shipments": "ship_date",
}

# What tells rows of a table apart where its key does not.
GOLD_IDENTITY = {
    "dim_customer": ["customer_sk"],
    "agg_daily_revenue": ["order_date", "brand", "region"],
    "agg_delivery_sla": ["planned_date", "carrier"],
    "agg_distributor_shipments": ["ship_date", "distributor"],
}


class Source(Protocol):
    """Anything that yields the rows of a table changed since a mark."""

    def read_increment(self, spark: SparkSession, table: str, mark: datetime) -> DataFrame: ...


class Lake:
    """Names of all tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str, landing: str = "", buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.landing = (landing or f"{self.root}/landing").rstrip("/")
        self.buckets = buckets
        self.runs = AppendLog(spark, f"{self.root}/ops/runs", RUN_SCHEMA)
        self.marks = SnapshotTable(spark, f"{self.root}/ops/marks", "source")

    def bronze(self, name: str) -> SnapshotTable:
        return self._table("bronze", name, ENTITIES[name], ENTITIES[name], MODIFIED)

    def silver(self, name: str) -> SnapshotTable:
        key = ENTITIES[name] if name in ENTITIES else FEEDS[name][1]
        return self._table("silver", name, key, key, *(["valid_from"] if name == "customers" else []))

    def gold(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/gold/{name}", GOLD_KEYS[name], identity=GOLD_IDENTITY.get(name))

    def _table(self, layer: str, name: str, key: str, *identity: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{layer}/{name}", key, self.buckets, identity)

    def landed(self, feed: Feed) -> DataFrame:
        return landed(self.spark, feed, f"{self.root}/bronze/{feed.name}")

    # -- marks -----------------------------------------------------------

    def mark(self, source: str) -> datetime:
        if not self.marks.exists():
            return NEVER_READ
        row = self.marks.read().where(F.col("source") == source).select("watermark").first()
        return row[0] if row else NEVER_READ

    def set_mark(self, source: str, moment: datetime) -> None:
        row = self.spark.range(1).select(
            F.lit(source).alias("source"),
            F.lit(moment).alias("watermark"),
            F.lit(datetime.now(UTC)).alias("updated_at"),
        )
        self.marks.upsert(row)


def take_in_table(lake: Lake, source: Source, name: str) -> dict[str, str]:
    """Extract one table since its mark, keep unseen versions, move the mark."""
    before = lake.mark(name)
    extract = stamp_load(source.read_increment(lake.spark, name, before), name)
    with extracted(extract, f"extract-{name}") as rows:
        inserted, latest = lake.bronze(name).insert_versions(rows, MODIFIED)
    if latest is not None:
        lake.set_mark(name, latest)
    return {
        "table": name,
        "rows": str(inserted),
        "watermark_before": before.isoformat(),
        "watermark_after": (latest or before).isoformat(),
    }


def take_in_drops(lake: Lake, name: str) -> int:
    """Stream the new files of one feed into bronze; returns rows."""
    feed = FEEDS[name][0]
    return land(
        lake.spark,
        feed,
        f"{lake.landing}/{name}",
        f"{lake.root}/bronze/{name}",
        f"{lake.root}/checkpoints/{name}",
    )


def _newest_of_touched(every: DataFrame, fresh: DataFrame, key: str, order: str) -> DataFrame:
    """Newest version of each key that got a new row, judged over all its versions.

    A late row older than what is known changes nothing, and keys without new
    rows are not looked at. Rows before the first fresh one can't be the newest
    of a key with a fresh row; statistics keep their files from being read.
    """
    keys = fresh.select(key).distinct()
    first = fresh.agg(F.min(order)).first()[0]
    later = every if first is None else every.where((F.col(order) >= F.lit(first)) | F.col(order).isNull())
    return conform.newest_version(touched_rows(later, keys, [key]), key, order)


def _newer_than_known(silver: SnapshotTable, updates: DataFrame, key: str) -> DataFrame:
    """Updates of keys that silver lacks or holds with an older row.

    Silver keeps the newest row of a key, so older versions need not be read.
    """
    if not silver.exists():
        return updates
    known = silver.touched_buckets(updates).select(key, F.col(MODIFIED).alias("_known"))
    newer = F.col("_known").isNull() | (F.col(MODIFIED) > F.col("_known"))
    return updates.join(known, key, "left").where(newer).select(*updates.columns)


def conform_entity(lake: Lake, name: str) -> tuple[int, int]:
    """Bring one database entity to silver; returns keys looked at and rows changed.

    Customers are judged over all their versions, because silver does not keep
    the time of a row that changed no tracked column.
    """
    bronze, silver, key = lake.bronze(name), lake.silver(name), ENTITIES[name]
    version = bronze.version()
    done = int(silver.note() or -1)
    if version is None or version <= done:
        return 0, 0
    fresh = conform.without_load_columns(bronze.rows_after(done))
    seen = fresh.select(key).distinct().count()
    if name == "customers":
        every = conform.without_load_columns(bronze.read())
        updates = _newest_of_touched(every, fresh, key, MODIFIED)
        tracked = [c for c in star.CUSTOMER_ATTRIBUTES if c in every.columns]
        return seen, silver.scd2(updates, tracked, MODIFIED, note=str(version))
    updates = _newer_than_known(silver, conform.newest_version(fresh, key, MODIFIED), key)
    return seen, silver.upsert(updates, note=str(version))


def conform_feed(lake: Lake, name: str) -> tuple[int, int]:
    """Bring one file feed to silver; a feed without files does nothing."""
    feed, key = FEEDS[name]
    silver = lake.silver(name)
    rows = typed(lake.landed(feed), feed)
    done = int(silver.note() or -1)
    fresh = rows.where(F.col("_batch") > done)
    newest = fresh.agg(F.max("_batch"), F.countDistinct(key)).first()
    if newest[0] is None:
        return 0, 0
    updates = _newest_of_touched(rows, fresh, key, "_ingest_ts").drop("_rescued_data", "_batch")
    return newest[1], silver.upsert(updates, note=str(newest[0]))


def refresh_silver(lake: Lake) -> dict[str, str]:
    """Bronze to silver for all entities; ``rows_changed`` decides about gold."""
    metrics: dict[str, str] = {}
    changed = 0
    steps: list[tuple[str, Callable[[Lake, str], tuple[int, int]]]] = [
        *[(n, conform_entity) for n in ENTITIES],
        *[(n, conform_feed) for n in FEEDS],
    ]
    for name, step in steps:
        seen, rows = step(lake, name)
        metrics[f"{name}_in"] = str(seen)
        changed += rows
    lost = conform.orphan_count(
        lake.silver("orders").read(), lake.silver("customers").read(), "customer_id", "n"
    )
    metrics["orders_ref_violations"] = str(lost.first()[0])
    metrics["rows_changed"] = str(changed)
    return metrics


def silver_versions(lake: Lake) -> dict[str, int]:
    found = {n: lake.silver(n).version() for n in (*ENTITIES, *FEEDS)}
    return {n: v for n, v in found.items() if v is not None}


def refresh_gold(lake: Lake) -> dict[str, str]:
    """Rebuild gold from silver, check it, then publish all tables.

    Nothing happens while gold already stems from the current silver versions,
    and a failed gate leaves the published tables as they were.
    """
    note = json.dumps(silver_versions(lake), sort_keys=True)
    # Tables are published one after the other; after a crash in between some have an older note.
    published = {name: lake.gold(name).note() for name in GOLD_KEYS}
    due = set(GOLD_KEYS) - ({"agg_distributor_shipments"} if lake.silver("shipments").version() is None else set())
    if all(published[name] == note for name in due):
        return {"skipped": "silver unchanged"}
    silver = {n: lake.silver(n).read() for n in silver_versions(lake)}
    staged: dict[str, tuple[SnapshotTable, Staged]] = {}

    def build(name: str, rows: DataFrame) -> DataFrame:
        """Write a table unpublished and go on with its written rows."""
        table = lake.gold(name)
        staged[name] = (table, table.stage(rows))
        return table.staged_rows(staged[name][1])

    customers = build("dim_customer", star.customer_dimension(silver["customers"]))
    products = build("dim_product", star.product_dimension(silver["products"]))
    build("dim_date", star.calendar_dimension(silver["orders"]))
    fact = build(
        "fact_sales",
        star.sales_fact(silver["order_lines"], silver["orders"], customers, products),
    )
    build("agg_daily_revenue", star.daily_revenue(fact, customers, products))
    build("agg_delivery_sla", star.delivery_sla(silver["deliveries"]))
    if "shipments" in silver:
        build("agg_distributor_shipments", star.distributor_volume(silver["shipments"]))

    check(lake, gates.standard_gates(silver["orders"], silver["customers"], fact))
    metrics = {}
    for name, (table, version) in staged.items():
        size = table.staged_rows(version).count()
        table.publish(version, "overwrite", counts={"insert": size}, note=note)
        metrics[name] = str(size)
    return metrics


def check(lake: Lake, report: DataFrame, task: str = "quality_gates") -> None:
    """Log every gate in one run record, then fail if any gate failed."""
    started = datetime.now(UTC)
    results = report.collect()
    failed = sum(not r["passed"] for r in results)
    log_run(
        lake.runs,
        task,
        "failed" if failed else "succeeded",
        started,
        gates.as_metrics(results),
        f"{failed} of {len(results)} gates failed" if failed else None,
    )
    gates.require_passed(results)


def logged(lake: Lake, task: str, work: Callable[[], Mapping[str, object]]) -> Mapping[str, object]:
    """Run a step and log its outcome, also when it fails."""
    started = datetime.now(UTC)
    try:
        metrics = work()
    except Exception as error:
        log_run(lake.runs, task, "failed", started, message=f"{type(error).__name__}: {error}")
        raise
    log_run(lake.runs, task, "succeeded", started, metrics)
    return metrics


def refresh(lake: Lake, source: Source) -> dict[str, Mapping[str, object]]:
    """One complete run: intake, silver, gold and freshness."""
    out: dict[str, Mapping[str, object]] = {}
    for name in FEEDS:
        task = f"bronze_files_{name}"
        out[task] = logged(lake, task, lambda n=name: {"rows": take_in_drops(lake, n)})
    for name in ENTITIES:
        task = f"bronze_sql_{name}"
        out[task] = logged(lake, task, lambda n=name: take_in_table(lake, source, n))
    out["silver"] = logged(lake, "silver", lambda: refresh_silver(lake))
    out["gold"] = logged(lake, "gold", lambda: refresh_gold(lake))
    out["freshness"] = logged(lake, "refresh_metrics", lambda: freshness(lake))
    return out


def freshness(lake: Lake) -> dict[str, str]:
    layers = {
        "bronze": (lake.bronze("orders").read(), "_ingest_ts"),
        "silver": (lake.silver("orders").read(), "_ingest_ts"),
        "gold": (lake.gold("fact_sales").read(), "order_date"),
    }
    return {
        f"{layer}_freshness": str(rows.agg(F.max(column)).first()[0])
        for layer, (rows, column) in layers.items()
    }
