"""SQL of file drop queries."""

from oracle.staging import query

SHIPMENT = """shipment_id, cast(order_id as int) as order_id, distributor, ship_date, qty_cases,
    warehouse"""

SQL = {
    "stream_csv_ingest": query(f"select {SHIPMENT} from stg_shipments"),
    "stream_json_ingest": query(
        "select * replace (cast(order_id as int) as order_id) from stg_returns"
    ),
    "stream_evolved_columns": query(
        f"""select {SHIPMENT}, cast(case when ship_date >= date '1997-01-01'
            then qty_cases % 3 end as int) as priority from stg_shipments"""
    ),
    "stream_nested_columns": query(
        """
        select * replace (cast(order_id as int) as order_id),
               case when return_date >= date '1997-01-01' then 'C' || (quantity % 3) end as details_carrier,
               cast(case when return_date >= date '1997-01-01' and not (return_date >= date '1999-06-01'
                    and quantity > 40) then quantity * 2 end as int) as details_weight,
               case when return_date >= date '1999-06-01' and quantity > 40
                    then '{"details_weight":"heavy"}' end as details_rescued
        from stg_returns
        """
    ),
    "rescued_rows": query(
        """
        select return_id, cast(order_id as int) as order_id, '00' || order_id as product_sku,
               return_date, case when quantity <= 40 then quantity end as quantity, reason,
               case when quantity > 40 and reason = 'O'
                    then '{"quantity":"many","remark":"late"}'
                    when quantity > 40 then '{"quantity":"many"}'
                    when reason = 'O' then '{"remark":"late"}' end as _rescued_data
        from stg_returns
        """
    ),
    "rows_per_source_file": query(
        """
        select case when ship_date < date '1997-01-01' then 'drop-1'
                    when ship_date < date '1999-06-01' then 'drop-2' else 'drop-3' end as drop_name,
               count(*) as row_count, count(*) as stamped
        from stg_shipments group by all
        """
    ),
}
