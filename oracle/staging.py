"""Staging views as DuckDB SQL; the text follows FIXTURES.md section 4."""

VIEWS: dict[str, str] = {
    "stg_customers": """
        select c_custkey as customer_id, c_name as customer_name, n_name as city, r_name as region,
        c_mktsegment as segment, cast(c_acctbal as decimal(12,2)) as credit_limit from customer join
        nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    """,
    "stg_products": """
        select p_partkey as product_id, concat('SKU-', cast(p_partkey as string)) as sku, p_name as
        product_name, p_brand as brand, p_type as category, cast(p_retailprice as decimal(9,2)) as
        unit_price, p_size as package from part
    """,
    "stg_orders": """
        select o_orderkey as order_id, o_custkey as customer_id, cast(o_orderdate as date) as
        order_date, case when o_orderkey % 33 = 0 then 'cancelled' when o_orderstatus = 'F' then
        'delivered' when o_orderstatus = 'P' then 'shipped' else 'placed' end as status, case
        o_orderkey % 3 when 0 then 'direct' when 1 then 'distributor' else 'online' end as channel,
        o_orderdate as modified_at from orders
    """,
    "stg_lines": """
        select * from (select l_orderkey * 8 + l_linenumber as order_line_id, l_orderkey as
        order_id, l_partkey as product_id, l_suppkey as supplier_id, cast(l_quantity as int) as
        quantity, cast(p_retailprice as decimal(9,2)) as unit_price, cast(cast(l_discount as
        decimal(5,2)) * 100 as decimal(5,2)) as discount_pct, cast(l_shipdate as date) as ship_date,
        l_returnflag, l_linestatus, row_number() over (partition by l_orderkey * 8 + l_linenumber
        order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice
        desc, l_tax desc, l_discount desc, l_returnflag, l_linestatus) as rn from lineitem join part
        on l_partkey = p_partkey) x where rn = 1
    """,
    "stg_deliveries": """
        select order_line_id as delivery_id, order_id, ship_date as planned_date, case when
        l_linestatus = 'O' and order_line_id % 4 = 0 then null else ship_date + cast(order_line_id %
        6 - 1 as int) end as actual_date, l_returnflag as carrier from stg_lines
    """,
    "stg_shipments": """
        select order_line_id as shipment_id, order_id, s_name as distributor, ship_date, quantity as
        qty_cases, concat(l_returnflag, l_linestatus) as warehouse from stg_lines join supplier on
        supplier_id = s_suppkey
    """,
    "stg_returns": """
        select order_line_id as return_id, order_id, concat('SKU-', cast(product_id as string)) as
        product_sku, ship_date as return_date, quantity, l_linestatus as reason from stg_lines where
        l_returnflag = 'R'
    """,
    "hist": """
        select customer_id, segment, valid_from, lead(valid_from) over (partition by customer_id
        order by valid_from) as valid_to from (select customer_id, segment, valid_from, lag(segment)
        over (partition by customer_id order by valid_from) as prev from (select o_custkey as
        customer_id, o_orderpriority as segment, o_orderdate as valid_from, row_number() over
        (partition by o_custkey, o_orderdate order by o_orderkey desc) as rn from orders) a where rn
        = 1) b where prev is null or prev <> segment
    """,
    "stg_runs": """
        select event_id as run_id, event_type as task, case when event_type = 'error' then 'failed'
        else 'succeeded' end as status, ts as started_at, ts as finished_at, props as message, value
        from events
    """,
    "stg_jobs": """
        select o_custkey as job_id, o_orderpriority as name, o_orderdate as change_time, o_orderkey
        as seq from orders
    """,
    "stg_usage": """
        select order_line_id as usage_id, case when order_line_id % 89 <> 0 then l_returnflag end as sku_name,
        l_linestatus as cloud, ship_date as usage_date, case when order_line_id % 97 <> 0 then ship_date end as usage_end,
        cast(quantity * 0.25 as decimal(12,2)) as usage_quantity, supplier_id as variant, order_id as job_run_id from stg_lines
    """,
    "stg_prices": """
        select l_returnflag as sku_name, l_linestatus as cloud, yr as price_year, min(ship_date) as
        price_start, lead(min(ship_date)) over (partition by l_returnflag, l_linestatus order by yr)
        as price_end, cast(yr - 1990 as decimal(9,2)) as price from (select l_returnflag,
        l_linestatus, ship_date, year(ship_date) as yr from stg_lines where year(ship_date) >= 1996)
        y group by l_returnflag, l_linestatus, yr
    """,
}

# Customer attributes joined to the segment history, as one dimension.
VIEWS["cust_hist"] = """
        select c.customer_id, customer_name, city, region, h.segment, credit_limit,
               h.valid_from, h.valid_to, h.valid_to is null as is_current
        from stg_customers c join hist h on c.customer_id = h.customer_id
    """


def query(body: str, **extra: str) -> str:
    """``body`` with the staging views (and ``extra`` ones) in front."""
    views = {**VIEWS, **extra}
    head = ",\n".join(f"{name} as ({text})" for name, text in views.items())
    return f"with {head}\n{body}"
