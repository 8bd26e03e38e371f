"""Queries over gates, run records, dashboards, cost and benchmark rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import trailing_days
from strata.operators import benchmarks, gates, marts, runs, star
from strata.plans.registry import query
from strata.plans.staging import Staging
from strata.plans.star_queries import dimensions, fact

# Report dates: last order day, last ship day, day after the last event.
ORDERS_AS_OF = date(2001, 8, 1)
SHIPPED_AS_OF = date(2001, 11, 4)
EVENTS_AS_OF = datetime(2024, 1, 31)
PRICED_BY = ("sku_name", "cloud")


def daily(s: Staging) -> DataFrame:
    """Revenue of the reported days; older orders go before their versions are looked up."""
    recent = s.orders.where(trailing_days("order_date", ORDERS_AS_OF, 90))
    customers, products = dimensions(s)
    sales = star.sales_fact(s.lines, recent, customers, products, ["region"], ["brand"])
    return star.daily_revenue(sales, customers, products)


@query
def gate_row_count(s: Staging) -> DataFrame:
    return gates.check_table(
        s.orders, "silver.orders", [gates.at_least(1), gates.at_least(10**15)]
    )


@query
def gate_pk_unique(s: Staging) -> DataFrame:
    lines = s.line_versions
    return gates.check_table(lines, "bronze.order_lines", [gates.unique("order_line_id")])


@query
def gate_null_ratio(s: Staging) -> DataFrame:
    checks = [gates.mostly_set("actual_date", limit) for limit in (0.0, 0.5)]
    return gates.check_table(s.deliveries, "silver.deliveries", checks)


@query
def gate_report(s: Staging) -> DataFrame:
    """Three kinds of gate on one table, answered together."""
    checks = [
        gates.at_least(1),
        gates.unique("delivery_id"),
        gates.mostly_set("actual_date", 0.01),
        gates.mostly_set("carrier", 0.0),
    ]
    return gates.check_table(s.deliveries, "silver.deliveries", checks)


@query
def standard_gates(s: Staging) -> DataFrame:
    return gates.standard_gates(s.orders, s.customer_history, fact(s))


@query
def gate_both_sources(s: Staging) -> DataFrame:
    return gates.both_sources(fact(s), star.distributor_volume(s.shipments))


# -- operations ----------------------------------------------------------


@query
def layer_freshness(s: Staging) -> DataFrame:
    return runs.layer_freshness(
        {
            "bronze": (s.raw("orders"), "o_orderdate"),
            "silver": (s.orders, "modified_at"),
            "gold": (fact(s), "order_date"),
        }
    )


@query
def task_freshness(s: Staging) -> DataFrame:
    return runs.task_freshness(s.runs, EVENTS_AS_OF)


def measured_runs(s: Staging) -> DataFrame:
    """Runs with a metrics map; tasks report different entries, one a broken value."""
    rows = F.floor(F.col("value")).cast("string")
    entry = (
        F.when(F.col("task") == "click", F.create_map(F.lit("rows"), rows))
        .when(F.col("task") == "view", F.create_map(F.lit("rows_changed"), rows))
        .when(
            F.col("task") == "purchase",
            F.create_map(F.lit("rows_changed"), rows, F.lit("rows"), F.lit("-1")),
        )
        .when(F.col("task") == "signup", F.create_map(F.lit("rows"), F.lit("n/a")))
    )
    return s.runs.withColumn("metrics", entry)


@query
def rows_per_run(s: Staging) -> DataFrame:
    return runs.rows_per_run(measured_runs(s), EVENTS_AS_OF.date(), 14)


@query
def failure_log(s: Staging) -> DataFrame:
    return runs.failure_log(s.runs)


def timeline(s: Staging) -> DataFrame:
    """Job runs: an event is a run of the job its user stands for."""
    end = F.col("ts") + F.make_dt_interval(secs=F.floor(F.col("value")).cast("decimal(18,6)"))
    return s.raw("events").select(
        F.col("event_id").alias("run_id"),
        F.col("user_id").alias("job_id"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("result_state"),
        F.col("props").alias("trigger_type"),
        F.col("ts").alias("period_start_time"),
        end.alias("period_end_time"),
    )


@query
def job_run_history(s: Staging) -> DataFrame:
    return runs.job_run_history(timeline(s), s.jobs, EVENTS_AS_OF.date(), 20)


@query
def duration_trend(s: Staging) -> DataFrame:
    return runs.duration_trend(timeline(s), s.jobs, EVENTS_AS_OF.date(), 20)


@query
def gold_staleness(s: Staging) -> DataFrame:
    """One task that ran and one that never succeeded."""
    ran = runs.staleness(s.runs, "purchase", EVENTS_AS_OF)
    return ran.unionByName(runs.staleness(s.runs, "error", EVENTS_AS_OF))


# -- dashboards ----------------------------------------------------------


@query
def kpi_revenue_90d(s: Staging) -> DataFrame:
    return marts.revenue_kpi(daily(s), ORDERS_AS_OF)


@query
def kpi_on_time_30d(s: Staging) -> DataFrame:
    return marts.on_time_kpi(star.delivery_sla(s.deliveries), SHIPPED_AS_OF)


@query
def revenue_trend(s: Staging) -> DataFrame:
    return marts.revenue_trend(daily(s), ORDERS_AS_OF)


@query
def revenue_by_region(s: Staging) -> DataFrame:
    return marts.revenue_by_region(daily(s), ORDERS_AS_OF)


@query
def top_distributors(s: Staging) -> DataFrame:
    return marts.top_distributors(star.distributor_volume(s.shipments))


@query
def sla_trend(s: Staging) -> DataFrame:
    return marts.sla_trend(star.delivery_sla(s.deliveries), SHIPPED_AS_OF)


@query
def top_customers(s: Staging) -> DataFrame:
    return marts.top_customers(fact(s), dimensions(s)[0])


def tagged_usage(s: Staging) -> DataFrame:
    """Usage in the shape of billing records: tags as a map, job as a struct."""
    on_job = F.col("sku_name") != "N"
    return s.usage.select(
        "sku_name",
        "cloud",
        "usage_date",
        F.col("usage_date").alias("usage_start"),
        "usage_end",
        "usage_quantity",
        F.when(on_job, F.create_map(F.lit("lab"), F.col("variant"))).alias("custom_tags"),
        F.struct(
            F.when(on_job, F.col("variant")).alias("job_id"), F.col("job_run_id")
        ).alias("usage_metadata"),
    )


@query
def cost_daily_by_sku(s: Staging) -> DataFrame:
    return marts.cost_daily_by_sku(tagged_usage(s), s.prices, SHIPPED_AS_OF, 365, keys=PRICED_BY)


@query
def cost_per_variant(s: Staging) -> DataFrame:
    return marts.cost_per_variant(tagged_usage(s), s.prices, "lab", keys=PRICED_BY)


@query
def cost_per_run(s: Staging) -> DataFrame:
    return marts.cost_per_run(tagged_usage(s), s.prices, SHIPPED_AS_OF, keys=PRICED_BY)


# -- benchmark rows ------------------------------------------------------


def benchmark_rows(s: Staging) -> DataFrame:
    """Events as benchmark rows: the type is the case, a user group the variant."""
    category = (
        F.when(F.col("event_type").isin("click", "view"), "layout")
        .when(F.col("event_type") == "purchase", "cluster")
        .otherwise("query")
    )
    group = F.concat(F.lit("v"), F.col("user_id") % 7)

    def config(first: str, second: str):
        return F.create_map(F.lit(first), F.col("event_type"), F.lit(second), group)

    settings = (
        F.when(F.col("category") == "layout", config("query", "variant"))
        .when(F.col("category") == "cluster", config("workload", "variant"))
        .otherwise(config("case", "phase"))
    )
    return (
        s.raw("events")
        .withColumn("category", category)
        .select(
            F.col("event_id").alias("bench_id"),
            "ts",
            "category",
            F.col("event_type").alias("name"),
            settings.alias("config"),
            F.create_map(F.lit("props"), F.col("props")).alias("metrics"),
            (F.col("value").cast("decimal(12,2)") * 1000).cast("bigint").alias("duration_ms"),
        )
    )


@query
def bench_layout(s: Staging) -> DataFrame:
    return benchmarks.best_layouts(benchmark_rows(s))


@query
def bench_cluster(s: Staging) -> DataFrame:
    return benchmarks.best_clusters(benchmark_rows(s))


@query
def bench_rewrites(s: Staging) -> DataFrame:
    return benchmarks.best_rewrites(benchmark_rows(s))


@query
def bench_warm_median(s: Staging) -> DataFrame:
    return benchmarks.warm_median(benchmark_rows(s))


@query
def benchmarks_json(s: Staging) -> DataFrame:
    return benchmarks.as_json_lines(benchmark_rows(s))
