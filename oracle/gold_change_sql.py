"""SQL of the aggregates that follow changes: each is built anew from the later state."""

from oracle.staging import VIEWS
from oracle.star_sql import DAILY, SLA, STAR, VOLUME

LATER = {
    "all_orders": VIEWS["stg_orders"],
    "all_lines": VIEWS["stg_lines"],
    "all_deliveries": VIEWS["stg_deliveries"].replace("stg_lines", "all_lines"),
    "all_shipments": VIEWS["stg_shipments"].replace("stg_lines", "all_lines"),
}


def later(body: str, **extra: str) -> str:
    """The query over the later states, which stand under the names of the staging views."""
    views = {
        **{name: text for name, text in VIEWS.items() if name in ("stg_customers", "stg_products", "hist", "cust_hist")},
        **LATER,
        "stg_orders": "select * from all_orders where not (channel = 'online' and modified_at < timestamp '1998-01-01')",
        "stg_lines": "select * from all_lines where not (l_returnflag = 'R' and ship_date < date '1996-01-01')",
        "stg_deliveries": "select * from all_deliveries where not (carrier = 'R' and planned_date < date '1996-01-01')",
        "stg_shipments": "select * from all_shipments where not (warehouse = 'RF' and ship_date < date '1997-01-01')",
        **extra,
    }
    head = ",\n".join(f"{name} as ({text})" for name, text in views.items())
    return f"with {head}\n{body}"


SQL = {
    "agg_daily_revenue_followed": later(DAILY, **STAR),
    "agg_delivery_sla_followed": later(SLA),
    "agg_distributor_shipments_followed": later(VOLUME),
}
