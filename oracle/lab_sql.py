"""SQL of lab, generator and layout queries."""

from oracle.staging import query
from oracle.xxhash import draws
from strata.sources import generate as g

SALES = {
    "sales": """
        select l_orderkey * 8 + l_linenumber as sale_id, l_shipdate as sale_date,
               l_partkey as product_id, l_suppkey as supplier_id, l_returnflag as region,
               l_linestatus as channel, cast(l_quantity as int) as quantity,
               cast(l_extendedprice as decimal(12,2)) as revenue from lineitem
    """,
    "osales": """
        select o_orderkey as sale_id, cast(o_orderdate as date) as sale_date,
               o_custkey as customer_id, o_orderpriority as region, 1 as quantity,
               cast(o_totalprice as decimal(12,2)) as revenue from orders
    """,
    "weeks": """
        select cast(unnest(generate_series(0, date_diff('day', min(o_orderdate)::date,
               max(o_orderdate)::date) // 7)) as bigint) as week,
               min(o_orderdate)::date as day0 from orders
    """,
}


def promotions(regions: str, width: int) -> str:
    return f"""
        select cast(week * {width} + position as bigint) as promo_id, region,
               day0 + cast(week * 7 as int) as promo_start,
               day0 + cast(week * 7 + 9 as int) as promo_end
        from weeks, ({regions}) r
    """


REVENUE = "cast(sum(revenue) as decimal(18,2)) as revenue"
VOLUME = f"count(*) as sales, {REVENUE}"
PROMOTED = query(
    """
    select sale_id, revenue, promo_id from osales s join promos p on s.region = p.region
    where sale_date between date '1998-03-01' and date '1998-03-31'
      and sale_date between promo_start and promo_end
    """,
    **SALES,
    promos=promotions(
        """select * from (values (0, '1-URGENT'), (1, '2-HIGH'), (2, '3-MEDIUM'),
           (3, '4-NOT SPECIFIED'), (4, '5-LOW')) t(position, region)""",
        5,
    ),
)
MONTH = query(
    f"""select channel, {VOLUME} from sales
        where year(sale_date) = 1998 and month(sale_date) = 6 group by channel""",
    **SALES,
)
LABELLED = query(
    """select sale_id, quantity, revenue, c_mktsegment as brand
       from osales join customer on customer_id = c_custkey
       where sale_date between date '1998-01-01' and date '1998-06-30'""",
    **SALES,
)
BRANDED = query(
    f"""select p_brand as brand, {REVENUE} from sales join part on product_id = p_partkey
        group by brand""",
    **SALES,
)
CATEGORIES = query(
    f"""select p_type as category, {VOLUME} from sales join part on product_id = p_partkey
        group by category""",
    **SALES,
)


def word(words: tuple[str, ...], column: str) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"[{listed}][{column} + 1]"


GENERATED = {
    "made": f"""
        select sale_id, date '2023-01-01' + cast(d_date as int) as sale_date,
               case when d_hot < 3 then 42 else d_customer end as customer_id,
               d_product as product_id, {word(g.REGIONS, 'd_region')} as region,
               {word(g.CHANNELS, 'd_channel')} as channel, cast(d_quantity + 1 as int) as quantity,
               cast((d_price + 200) * cast(0.01 as decimal(3,2)) as decimal(8,2)) as unit_price
        from ({draws("select order_line_id as sale_id from stg_lines", "sale_id", {
            "d_date": (1, 1095), "d_hot": (2, 10), "d_customer": (3, 50000),
            "d_product": (4, 200), "d_quantity": (5, 24), "d_price": (6, 900),
            "d_region": (7, 8), "d_channel": (8, 3)})})
    """,
    "made_rows": """
        select *, cast(quantity * unit_price as decimal(12,2)) as revenue,
               sha1('lf-' || sale_id) as order_ref from made
    """,
}
LINES = query("select * exclude (rn) from stg_lines")

SQL = {
    "lab_selective_window": query(
        f"""select sale_date, {REVENUE} from sales where supplier_id = 3
            and sale_date between date '1998-03-01' and date '1998-03-30' group by sale_date""",
        **SALES,
    ),
    "lab_single_day": query(
        f"select channel, {VOLUME} from sales where sale_date = date '1998-06-15' group by channel",
        **SALES,
    ),
    "lab_full_scan": query(f"select region, {VOLUME} from sales group by region", **SALES),
    "lab_hot_key": query(
        f"""select {VOLUME} from sales where product_id = (select product_id from sales
            group by product_id order by count(*) desc, product_id limit 1)""",
        **SALES,
    ),
    "lab_exploding_bad": PROMOTED,
    "lab_exploding_rewritten": PROMOTED,
    "lab_nonsargable_bad": MONTH,
    "lab_nonsargable_rewritten": MONTH,
    "lab_distinct_bad": LABELLED,
    "lab_distinct_rewritten": LABELLED,
    "lab_dim_join_shuffle": BRANDED,
    "lab_dim_join_broadcast": BRANDED,
    "lab_skew_join": CATEGORIES,
    "lab_skew_join_salted": CATEGORIES,
    "lab_scan_two_keys": query(
        f"""select region, channel, {VOLUME}, avg(quantity) as avg_quantity
            from sales group by all""",
        **SALES,
    ),
    "lab_skew_two_keys": query(
        f"""select p_type as category, p_brand as brand, {VOLUME}
            from sales join part on product_id = p_partkey group by all""",
        **SALES,
    ),
    "lab_selective_open": query(
        f"""select sale_date, {REVENUE} from sales where supplier_id = 3
            and sale_date >= date '1998-01-01' group by sale_date""",
        **SALES,
    ),
    "gen_sales": query("select * from made_rows", **GENERATED),
    "gen_sales_profile": query(
        """
        select region, channel, count(*) as sales,
               count(*) filter (where customer_id = 42) as hot_sales,
               count(distinct order_ref) as refs, min(sale_date) as first_day,
               max(sale_date) as last_day, cast(sum(quantity) as bigint) as quantity,
               cast(sum(revenue) as decimal(18,2)) as revenue
        from made_rows group by all
        """,
        **GENERATED,
    ),
    "gen_customers_profile": f"""
        select {word(g.REGIONS, 'd_region')} as region, {word(g.SEGMENTS, 'd_segment')} as segment,
               count(*) as customers, count(distinct 'Customer ' || c_custkey) as names,
               cast(sum(d_limit * 100) as bigint) as credit_limit
        from ({draws("select c_custkey from customer", "c_custkey", {
            "d_region": (11, 8), "d_segment": (12, 3), "d_limit": (13, 500)})}) group by all
    """,
    "gen_products_profile": f"""
        select {word(g.BRANDS, 'd_brand')} as brand, {word(g.CATEGORIES, 'd_category')} as category,
               count(*) as products, count(distinct 'Brew ' || p_partkey) as names
        from ({draws("select p_partkey from part", "p_partkey", {
            "d_brand": (14, 4), "d_category": (15, 4)})}) group by all
    """,
    "gen_promotions": query(
        promotions("select r_regionkey as position, r_name as region from region", 8), **SALES
    ),
    "gen_drops_profile": f"""
        select {word(g.DISTRIBUTORS, 'd_partner')} as distributor,
               {word(g.WAREHOUSES, 'd_place')} as warehouse, count(*) as shipments,
               cast(sum(d_cases + 1) as bigint) as cases,
               min(day - cast(d_day as int)) as first_day, max(day - cast(d_day as int)) as last_day,
               max((cast(strftime(day, '%Y%m%d') as bigint) * 100 + 1) * 1000000000 + o_orderkey) as last_id
        from ({draws("select o_orderkey, cast(o_orderdate as date) as day from orders",
            "o_orderkey", {"d_partner": (22, 5), "d_day": (23, 3), "d_cases": (24, 120),
                           "d_place": (25, 4)})}) group by all
    """,
    "gen_returns_profile": f"""
        select 'SKU-' || lpad(cast(d_product + 1 as varchar), 3, '0') as product_sku,
               {word(g.RETURN_REASONS, 'd_place')} as reason, count(*) as returns,
               cast(sum(d_cases + 1) as bigint) as quantity, min(day) as first_day, max(day) as last_day,
               max((cast(strftime(day, '%Y%m%d') as bigint) * 100 + 2) * 1000000000 + o_orderkey) as last_id
        from ({draws("select o_orderkey, cast(o_orderdate as date) as day from orders",
            "o_orderkey", {"d_product": (22, 40), "d_cases": (24, 24), "d_place": (25, 4)})}) group by all
    """,
    "gen_key_coverage": query(
        """
        select count(*) filter (where customer_id not between 0 and 49999) as orphans,
               'customers' as dimension from made
        union all
        select count(*) filter (where product_id not between 0 and 199), 'products' from made
        """,
        **GENERATED,
    ),
    "layout_smallfiles": LINES,
    "layout_compacted": LINES,
    "layout_zorder": LINES,
    "layout_kd": LINES,
    "layout_clustered": LINES,
    "layout_pruned_rows": query(
        """
        select layout, count(*) as row_count, count(*) filter (where wanted) as wanted_rows,
               cast(coalesce(sum(quantity) filter (where wanted), 0) as bigint) as wanted_quantity
        from (select quantity, product_id between 100 and 110
                     and ship_date between date '1998-03-01' and date '1998-03-30' as wanted from stg_lines),
             unnest(['smallfiles', 'compacted', 'zorder', 'kd', 'clustered', 'partitioned']) as l(layout)
        group by all
        """
    ),
    "layout_partitioned": LINES,
}
