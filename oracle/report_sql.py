"""SQL of gate, run, dashboard, cost and benchmark queries."""

from oracle.staging import query
from oracle.star_sql import DAILY, FACT, SLA, STAR, VOLUME


def gate(kind: str, table: str, measured: str, passed: str, shown: str, wanted: str) -> str:
    return f"""select '{kind}' as gate, '{table}' as table_name, {passed} as passed,
        {shown} as observed, '{wanted}' as expected from ({measured}) m"""


def count_gate(table: str, source: str, minimum: int) -> str:
    return gate(
        "row_count_min", table, f"select count(*) as n from {source}",
        f"n >= {minimum}", "cast(n as varchar)", f">={minimum}",
    )


def unique_gate(table: str, source: str, key: str) -> str:
    dup = f"select {key} from {source} group by {key} having count(*) > 1"
    return gate(
        "pk_unique", table, f"select count(*) as n from ({dup}) d",
        "n = 0", "n || ' duplicate keys'", "0",
    )


def null_gate(table: str, source: str, column: str, limit: float) -> str:
    measured = f"""select coalesce(cast(count(*) filter (where {column} is null) as double)
        / nullif(count(*), 0), 0) as r from {source}"""
    return gate(
        "null_ratio_max", f"{table}.{column}", measured,
        f"r <= {limit}", "printf('%.4f', r)", f"<={limit}",
    )


BENCH = {
    "bench": """
        select event_id, ts, event_type as name, 'v' || (user_id % 7) as variant,
               cast(cast(value as decimal(12,2)) * 1000 as bigint) as duration_ms
        from events
    """
}
COST = """
    cast(sum(usage_quantity) as decimal(32,2)) as dbus,
    cast(sum(usage_quantity * coalesce(p.price, 0)) as decimal(18,2)) as usd
    from stg_usage u left join stg_prices p on u.sku_name = p.sku_name and u.cloud = p.cloud
     and u.usage_end >= p.price_start and (p.price_end is null or u.usage_end < p.price_end)
"""
JOBS = {
    "names": """select job_id, name as job_name from (select *, row_number() over
        (partition by job_id order by change_time desc, seq desc) as rn from stg_jobs) j
        where rn = 1""",
    "line": """select event_id as run_id, user_id as job_id,
        case when event_type <> 'view' then event_type end as result_state,
        props as trigger_type, ts as period_start_time,
        ts + to_seconds(cast(floor(value) as int)) as period_end_time,
        cast(floor(value) as bigint) as seconds from events""",
}
RECENT_JOBS = """from line join names using (job_id) where result_state is not null
    and period_start_time >= date '2024-01-31' - 20"""


def best(kinds: str, first: str, second: str) -> str:
    return query(
        f"""select name as {first}, variant as {second}, min(duration_ms) as duration_ms
            from bench where name in ({kinds}) group by all""",
        **BENCH,
    )


SQL = {
    "gate_row_count": query(
        count_gate("silver.orders", "stg_orders", 1)
        + " union all "
        + count_gate("silver.orders", "stg_orders", 10**15)
    ),
    "gate_pk_unique": query(
        unique_gate(
            "bronze.order_lines",
            "(select l_orderkey * 8 + l_linenumber as order_line_id from lineitem) l",
            "order_line_id",
        )
    ),
    "gate_null_ratio": query(
        null_gate("silver.deliveries", "stg_deliveries", "actual_date", 0.0)
        + " union all "
        + null_gate("silver.deliveries", "stg_deliveries", "actual_date", 0.5)
    ),
    "gate_report": query(
        " union all ".join(
            [
                count_gate("silver.deliveries", "stg_deliveries", 1),
                unique_gate("silver.deliveries", "stg_deliveries", "delivery_id"),
                null_gate("silver.deliveries", "stg_deliveries", "actual_date", 0.01),
                null_gate("silver.deliveries", "stg_deliveries", "carrier", 0.0),
            ]
        )
    ),
    "standard_gates": query(
        " union all ".join(
            [
                count_gate("silver.orders", "stg_orders", 1),
                unique_gate("silver.orders", "stg_orders", "order_id"),
                unique_gate("silver.customers[current]", "current_cust", "customer_id"),
                count_gate("gold.fact_sales", "keyed", 1),
                unique_gate("gold.fact_sales", "keyed", "order_line_id"),
                null_gate("gold.fact_sales", "keyed", "customer_sk", 0.0),
                null_gate("gold.fact_sales", "keyed", "product_sk", 0.01),
            ]
        ),
        dimc="select * from cust_hist",
        fact=FACT,
        current_cust="select * from cust_hist where is_current",
        keyed="""select order_line_id, fact.valid_from as customer_sk, p.product_id as product_sk
                 from fact left join stg_products p on p.product_id = fact.product_id""",
    ),
    "gate_both_sources": query(
        """select (select count(*) from fact) as fact_rows,
                  (select count(*) from volume) as volume_rows, true as passed""",
        **STAR,
        volume=VOLUME,
    ),
    "layer_freshness": query(
        """
        select 'bronze' as layer, max(o_orderdate) as freshness from orders
        union all select 'silver', max(modified_at) from stg_orders
        union all select 'gold', cast(max(order_date) as timestamp) from stg_orders
                  where order_id in (select order_id from stg_lines)
        """
    ),
    "task_freshness": query(
        """select task, max(finished_at) as last_success,
                  date_sub('hour', max(finished_at), timestamp '2024-01-31') as hours_since
           from stg_runs where status = 'succeeded' group by task"""
    ),
    "rows_per_run": query(
        """
        select started_at, task, case when task <> 'signup'
               then cast(floor(value) as bigint) end as rows_processed
        from stg_runs where status = 'succeeded' and started_at >= date '2024-01-31' - 14
        """
    ),
    "failure_log": query(
        """select started_at, task, status, message from stg_runs where status <> 'succeeded'
           order by started_at desc, run_id limit 50"""
    ),
    "job_run_history": query(
        f"""select run_id, job_name, result_state, trigger_type, period_start_time,
                   period_end_time, cast(seconds as double) / 60 as duration_min {RECENT_JOBS}""",
        **JOBS,
    ),
    "duration_trend": query(
        f"""select cast(period_start_time as date) as run_date, job_name,
                   avg(seconds) / 60 as avg_duration_min {RECENT_JOBS} group by all""",
        **JOBS,
    ),
    "gold_staleness": query(
        """
        select 'purchase' as task, h as hours_since_refresh, h > 24 as alert from (
            select date_sub('hour', max(finished_at), timestamp '2024-01-31') as h
            from stg_runs where task = 'purchase' and status = 'succeeded') x
        union all select 'error', cast(999 as bigint), true
        """
    ),
    "kpi_revenue_90d": query(
        """select cast(sum(net_revenue) as decimal(18,2)) as net_revenue,
                  cast(sum(units_sold) as bigint) as units_sold,
                  cast(sum(orders) as bigint) as orders
           from daily where order_date >= date '2001-08-01' - 90""",
        **STAR,
        daily=DAILY,
    ),
    "kpi_on_time_30d": query(
        """select cast(sum(on_time) as double) / sum(deliveries) as on_time_rate
           from sla where planned_date >= date '2001-11-04' - 30""",
        sla=SLA,
    ),
    "revenue_trend": query(
        """select order_date, brand, cast(sum(net_revenue) as decimal(18,2)) as net_revenue
           from daily where order_date >= date '2001-08-01' - 90 group by all""",
        **STAR,
        daily=DAILY,
    ),
    "revenue_by_region": query(
        """select region, cast(sum(net_revenue) as decimal(18,2)) as net_revenue,
                  cast(sum(units_sold) as bigint) as units_sold
           from daily where order_date >= date '2001-08-01' - 90 group by all""",
        **STAR,
        daily=DAILY,
    ),
    "top_distributors": query(
        """select distributor, cast(sum(cases_shipped) as bigint) as cases_shipped,
                  cast(sum(shipments) as bigint) as shipments
           from volume group by all order by cases_shipped desc, distributor limit 10""",
        volume=VOLUME,
    ),
    "sla_trend": query(
        """select planned_date, carrier,
                  cast(sum(on_time) as double) / sum(deliveries) as on_time_rate
           from sla where planned_date >= date '2001-11-04' - 90 group by all""",
        sla=SLA,
    ),
    "top_customers": query(
        """select customer_name, region, cast(sum(net_amount) as decimal(18,2)) as net_revenue,
                  count(distinct order_id) as orders
           from fact where status <> 'cancelled' group by all
           order by net_revenue desc, customer_name, region limit 10""",
        **STAR,
    ),
    "cost_daily_by_sku": query(
        f"""select usage_date, u.sku_name, {COST}
            where usage_date >= date '2001-11-04' - 365 group by all"""
    ),
    "cost_per_variant": query(
        f"select variant, {COST} where u.sku_name <> 'N' group by all"
    ),
    "cost_per_run": query(
        f"""select variant as job_id, job_run_id as run_id, min(usage_date) as started, {COST}
            where u.sku_name <> 'N' and usage_date >= date '2001-11-04' - 30
            group by all order by started desc, job_id, run_id limit 50"""
    ),
    "bench_layout": best("'click', 'view'", "query", "variant"),
    "bench_cluster": best("'purchase'", "workload", "variant"),
    "bench_rewrites": best("'error', 'signup'", "rewrite_case", "phase"),
    "benchmarks_json": r"""
        select '{"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '","category":"' || category
               || '","name":"' || event_type || '","config":{"' || a || '":"' || event_type
               || '","' || b || '":"v' || (user_id % 7) || '"},"metrics":{"props":"'
               || replace(props, '"', '\"') || '"},"duration_ms":'
               || cast(cast(value as decimal(12,2)) * 1000 as bigint) || '}' as benchmark
        from events join (values ('click', 'layout', 'query', 'variant'),
            ('view', 'layout', 'query', 'variant'), ('purchase', 'cluster', 'workload', 'variant'),
            ('error', 'query', 'case', 'phase'), ('signup', 'query', 'case', 'phase'))
            t(kind, category, a, b) on kind = event_type
    """,
    "bench_warm_median": query(
        """select name, cast(floor(quantile_cont(duration_ms, 0.5)) as bigint) as warm_median_ms
           from (select *, row_number() over (partition by name order by ts, event_id) as rn
                 from bench) b where rn > 1 group by name""",
        **BENCH,
    ),
}
