"""SQL of merge, history, change feed, mark and version queries."""

from oracle.staging import query

FIRST, SECOND = "timestamp '1998-01-01'", "timestamp '2000-01-01'"


def batch(condition: str) -> str:
    return f"""
        select customer_id, segment, modified_at, seq from (
            select o_custkey as customer_id, o_orderpriority as segment,
                   o_orderdate as modified_at, o_orderkey as seq,
                   row_number() over (partition by o_custkey order by o_orderdate desc,
                       o_orderpriority desc, o_orderkey desc) as rn
            from orders where {condition}) x where rn = 1
    """


HISTORY = {
    "b1": batch(f"o_orderdate < {FIRST}"),
    "b2": batch(f"o_orderdate >= {FIRST}"),
    "h1": """select *, modified_at as valid_from, cast(null as timestamp) as valid_to,
                    true as is_current from b1""",
    "chg": """select b2.* from b2 left join b1 on b1.customer_id = b2.customer_id
              where b1.customer_id is null or b1.segment is distinct from b2.segment""",
    "h2": """
        select h1.customer_id, h1.segment, h1.modified_at, h1.seq, h1.valid_from,
               chg.modified_at as valid_to, chg.customer_id is null as is_current
        from h1 left join chg on h1.customer_id = chg.customer_id
        union all
        select *, modified_at, cast(null as timestamp), true from chg
    """,
}
ORDERS = {
    "ob": f"select * replace ('placed' as status) from stg_orders where modified_at < {SECOND}",
    "ou": f"select * from stg_orders where modified_at >= {FIRST}",
    "oc": """
        select ou.*, case when ob.order_id is null then 'insert' else 'update' end as op
        from ou left join ob on ou.order_id = ob.order_id
        where ob.order_id is null or ob.status is distinct from ou.status
           or ob.customer_id is distinct from ou.customer_id
           or ob.order_date is distinct from ou.order_date
           or ob.channel is distinct from ou.channel
           or ob.modified_at is distinct from ou.modified_at
    """,
    "oa": """select * from ob where order_id not in (select order_id from oc)
             union all select * exclude (op) from oc""",
    "feed": """
        select 'insert' as _change_type, oa.* from oa
        where order_id not in (select order_id from ob)
        union all
        select 'update_preimage', ob.* from ob
        where order_id in (select order_id from oc where op = 'update')
        union all
        select 'update_postimage', oa.* from oa
        where order_id in (select order_id from oc where op = 'update')
    """,
}
def version_step(older: str, newer: str, version: int) -> str:
    """Changes from one state to the next."""
    tail = f"cast({version} as bigint) as _commit_version, timestamp '2024-01-{version + 1:02d}' as _commit_timestamp"
    same = "o.status is not distinct from n.status and o.customer_id is not distinct from n.customer_id and o.order_date is not distinct from n.order_date and o.channel is not distinct from n.channel and o.modified_at is not distinct from n.modified_at"
    return f"""
        select 'insert' as _change_type, {tail}, n.* from {newer} n where order_id not in (select order_id from {older})
        union all select 'delete', {tail}, o.* from {older} o where order_id not in (select order_id from {newer})
        union all select 'update_preimage', {tail}, o.* from {older} o join {newer} n on o.order_id = n.order_id where not ({same})
        union all select 'update_postimage', {tail}, n.* from {older} o join {newer} n on o.order_id = n.order_id where not ({same})
    """


# The table of ``recorded_orders`` after each of its commits.
RECORDED = {
    **ORDERS,
    "r_none": "select * from ob where false",
    "r0": "select * from ob",
    "r1": "select * from oa",
    "r2": "select * replace (case when status = 'shipped' and channel = 'direct' then 'delivered' else status end as status) from r1",
    "r3": "select * from r2 where status <> 'cancelled'",
    "r4": "select * from r3 where order_id not in (select order_id from ou) union all select * from ou",
    "steps": " union all ".join(
        f"select * from ({version_step(a, b, v)})" for v, (a, b) in enumerate([("r_none", "r0"), ("r0", "r1"), ("r1", "r2"), ("r2", "r3"), ("r3", "r4")])
    ),
}
LINE_COLUMNS = """l_orderkey desc, l_partkey desc, l_suppkey desc, l_linenumber desc,
    l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc,
    l_linestatus desc"""
EDITED = {
    "v1": """select * replace (cast(case when reason = 'O' then quantity + 1 else quantity end
             as int) as quantity) from stg_returns""",
    "v2": "select * from v1 where return_date < date '2001-01-01'",
}

SQL = {
    "scd2_initial": query("select * from h1", **HISTORY),
    "scd2_apply_batch": query("select * from h2", **HISTORY),
    "scd2_full_history": query("select *, valid_to is null as is_current from hist"),
    "scd2_full_history_hot": query("select *, valid_to is null as is_current from hist"),
    "scd2_key_proof": query(
        """
        select customer_id, count(*) as total_rows,
               count(*) filter (where is_current) as current_rows,
               count(*) filter (where not is_current and valid_to is not null) as closed_rows,
               max(segment) filter (where is_current) as current_segment
        from h2 group by customer_id
        """,
        **HISTORY,
    ),
    "upsert_orders": query("select * from oa", **ORDERS),
    "upsert_change_counts": query(
        """select count(*) filter (where op = 'insert') as inserted,
                  count(*) filter (where op = 'update') as updated,
                  count(*) as rows_changed from oc""",
        **ORDERS,
    ),
    "silver_rows_changed": query(
        """select (select count(*) from oc) + (select count(*) from chg) as rows_changed,
                  true as refresh_gold""",
        **ORDERS,
        **HISTORY,
    ),
    "change_feed": query("select * from feed", **ORDERS),
    "change_feed_range": query("select * from steps", **RECORDED),
    "change_feed_per_commit": query(
        """select _commit_version, _change_type, count(*) as changes, count(distinct order_id) as orders
           from steps where _commit_version >= 2 group by all""",
        **RECORDED,
    ),
    "change_feed_recent": query(
        """
        select _change_type, _commit_version, order_id, status, modified_at from (
            select *, cast(1 as bigint) as _commit_version from feed
            union all select 'insert', ob.*, cast(0 as bigint) from ob) x
        order by _commit_version desc, order_id, _change_type limit 100
        """,
        **ORDERS,
    ),
    "bronze_merge_versions": f"""
        select * exclude (rn) from (select *, l_orderkey * 8 + l_linenumber as order_line_id,
            row_number() over (partition by l_orderkey * 8 + l_linenumber, l_shipdate
            order by {LINE_COLUMNS}) as rn from lineitem) x where rn = 1
    """,
    "silver_entity_counts": query(
        """
        select 'customers' as table_name, count(distinct o_custkey) as row_count from orders
        union all select 'products', count(*) from part
        union all select 'orders', count(*) from orders
        union all select 'order_lines', count(*) from stg_lines
        union all select 'deliveries', count(*) from stg_deliveries
        union all select 'shipments', count(*) from stg_shipments
        union all select 'returns', count(*) from stg_returns
        """
    ),
    "watermark_read": query(
        f"""
        select channel as source, coalesce(max(modified_at) filter (where modified_at < {FIRST}
               and channel <> 'online'), timestamp '1900-01-01') as watermark
        from stg_orders group by channel
        """
    ),
    "watermark_advance": query(
        f"""
        select channel as source, case when channel = 'direct'
               then max(modified_at) filter (where modified_at < {FIRST})
               else max(modified_at) end as watermark,
               case when channel = 'direct' then timestamp '2024-01-01'
                    else timestamp '2024-01-02' end as updated_at
        from stg_orders group by channel
        """
    ),
    "src_incremental": query(
        "select * from stg_orders where modified_at >= timestamp '1999-06-01'"
    ),
    "load_metadata": query(
        "select *, 'database' as _source_system, 'orders' as _source_table from stg_orders"
    ),
    "gold_rebuild_idempotent": query(
        """
        select *, cast(on_time as double) / deliveries as on_time_rate from (
        select planned_date, carrier, count(*) as deliveries,
               count(*) filter (where actual_date <= planned_date) as on_time,
               avg(date_diff('day', planned_date, actual_date)) as avg_delay_days
        from stg_deliveries where actual_date is not null group by all) x
        """
    ),
    "update_where": query("select * from v1", **EDITED),
    "delete_where": query(
        "select * from stg_returns where not coalesce(nullif(quantity, 13) > 40, false)"
    ),
    "read_version": query("select * from v1", **EDITED),
    "version_diff": query(
        """
        select count(*) as rows_first, (select count(*) from v2) as rows_latest,
               count(*) - (select count(*) from v2) as rows_removed,
               cast(sum(quantity) - (select sum(quantity) from v2) as bigint) as quantity_removed
        from stg_returns
        """,
        **EDITED,
    ),
    "restore_version": query("select * from v1", **EDITED),
    "version_history": query(
        """
        select cast(version as bigint) as version, operation,
               case when version = 1 then u else 0 end as updated,
               case when version = 2 then d else 0 end as deleted,
               case when version = 1 then u else 0 end as rows_updated,
               case when version = 2 then d else 0 end as rows_deleted
        from n, (values (0, 'overwrite'), (1, 'update'), (2, 'delete'), (3, 'compact'))
                 as t(version, operation)
        """,
        **EDITED,
        n="""select (select count(*) from stg_returns where reason = 'O') as u,
                    (select count(*) from v1) - (select count(*) from v2) as d""",
    ),
    "retention_candidates": """
        select cast(version as bigint) as version, operation, replaced_at
        from (values (0, 'overwrite', timestamp '2024-01-02'),
                     (1, 'update', timestamp '2024-01-03')) as t(version, operation, replaced_at)
    """,
}
