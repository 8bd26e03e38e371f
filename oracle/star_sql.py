"""SQL of conformance and star schema queries."""

from oracle.staging import query
from oracle.xxhash import hash_of

NET = "quantity * unit_price * (100 - discount_pct) * cast(0.01 as decimal(3,2))"

# Lines with the customer version of the order day, written as an interval join.
FACT = f"""
    select order_line_id, l.order_id, l.product_id, o.customer_id,
           coalesce(c.valid_from, e.valid_from) as valid_from,
           coalesce(c.segment, e.segment) as segment,
           coalesce(c.region, e.region) as region,
           coalesce(c.customer_name, e.customer_name) as customer_name,
           cast(strftime(order_date, '%Y%m%d') as int) as date_key,
           order_date, status, channel, quantity, l.unit_price, discount_pct,
           cast({NET.replace('unit_price', 'l.unit_price')} as decimal(14,2)) as net_amount
    from stg_lines l
    join stg_orders o on l.order_id = o.order_id
    left join dimc c on c.customer_id = o.customer_id and c.valid_from <= o.order_date
         and (c.valid_to is null or o.order_date < c.valid_to)
    left join (select * from (select *, row_number() over
                 (partition by customer_id order by valid_from) as rn from dimc) x where rn = 1) e
         on e.customer_id = o.customer_id
"""
STAR = {"dimc": "select * from cust_hist", "fact": FACT}
LATE = {
    "dimc": """select * replace (valid_from + interval 400 day as valid_from,
               valid_to + interval 400 day as valid_to) from cust_hist""",
    "fact": FACT,
}
READABLE = """
    select order_line_id, f.order_id, f.product_id, customer_id, valid_from, segment, date_key,
           order_date, status, channel, quantity, f.unit_price, discount_pct, net_amount
    from fact f
"""
DAILY = """
    select order_date, p.brand, region, cast(sum(net_amount) as decimal(24,2)) as net_revenue,
           cast(sum(quantity) as bigint) as units_sold, count(distinct order_id) as orders
    from fact join stg_products p on fact.product_id = p.product_id
    where status <> 'cancelled' group by all
"""
SLA = """
    select *, cast(on_time as double) / deliveries as on_time_rate from (
    select planned_date, carrier, count(*) as deliveries,
           count(*) filter (where actual_date <= planned_date) as on_time,
           avg(date_diff('day', planned_date, actual_date)) as avg_delay_days
    from stg_deliveries where actual_date is not null group by all) x
"""
VOLUME = """
    select ship_date, distributor, count(*) as shipments,
           cast(sum(qty_cases) as bigint) as cases_shipped,
           count(distinct warehouse) as warehouses_used
    from stg_shipments group by all
"""
DATES = """
    select cast(strftime(date, '%Y%m%d') as int) as date_key, date,
           cast(year(date) as int) as year, cast(quarter(date) as int) as quarter,
           cast(month(date) as int) as month, cast(dayofweek(date) + 1 as int) as day_of_week,
           dayofweek(date) in (0, 6) as is_weekend
    from (select cast(unnest(generate_series(min(order_date), max(order_date),
                 interval 1 day)) as date) as date from stg_orders) d
"""
GOLD = {**STAR, "daily": DAILY, "sla": SLA, "volume": VOLUME, "dates": DATES}

SQL = {
    "revenue_by_brand_segment": query(
        """
        select p.brand, segment, cast(sum(net_amount) as decimal(18,2)) as net_revenue,
               cast(sum(quantity) as bigint) as units_sold
        from fact join stg_products p on fact.product_id = p.product_id
        where status <> 'cancelled' group by all
        """,
        **STAR,
    ),
    "latest_per_key": """
        select * exclude (rn) from (select *, l_orderkey * 8 + l_linenumber as order_line_id,
            row_number() over (partition by l_orderkey * 8 + l_linenumber
            order by l_shipdate desc, l_orderkey desc, l_partkey desc, l_suppkey desc,
            l_linenumber desc, l_quantity desc, l_extendedprice desc, l_discount desc,
            l_tax desc, l_returnflag desc, l_linestatus desc) as rn from lineitem) x
        where rn = 1
    """,
    "apply_casts": query(
        """
        select shipment_id, cast(order_id as int) as order_id, distributor,
               case when shipment_id % 11 <> 0 then ship_date end as ship_date,
               case when shipment_id % 7 <> 0 then qty_cases end as qty_cases, warehouse,
               'drop-' || warehouse as _source_file
        from stg_shipments
        """
    ),
    "referential_violations": query(
        """
        select * from stg_orders o where not exists (select 1 from stg_customers c
            where c.segment <> 'MACHINERY' and c.customer_id = o.customer_id)
        """
    ),
    "orders_ref_violations": query(
        """
        select count(*) as orders_ref_violations from stg_orders
        where customer_id not in (select customer_id from stg_customers where segment <> 'MACHINERY')
        """
    ),
    "dim_customer": query(
        "select * exclude (micros) from ("
        + hash_of(
            "select *, epoch_us(valid_from) as micros from cust_hist",
            ["customer_id", "micros"],
            "customer_sk",
        )
        + ")"
    ),
    "dim_product": query(hash_of("select * from stg_products", ["product_id"], "product_sk")),
    "dim_date": query(DATES),
    "fact_sales": query(READABLE, **STAR),
    "fact_sales_fallback": query(READABLE, **LATE),
    "agg_daily_revenue": query(DAILY, **STAR),
    "agg_delivery_sla": query(SLA),
    "agg_distributor_shipments": query(VOLUME),
    "gold_table_counts": query(
        " union all ".join(
            f"select '{name}' as table_name, count(*) as row_count from {source}"
            for name, source in {
                "dim_customer": "dimc",
                "dim_product": "stg_products",
                "dim_date": "dates",
                "fact_sales": "fact",
                "agg_daily_revenue": "daily",
                "agg_delivery_sla": "sla",
                "agg_distributor_shipments": "volume",
            }.items()
        ),
        **GOLD,
    ),
}
