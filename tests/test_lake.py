from datetime import date, datetime
from decimal import Decimal

import pytest

from strata.operators.gates import GateFailure
from strata.plans import lake as plan
from strata.sources.increments import since
from tests.conftest import at, sets

SCHEMAS = {
    "customers": "customer_id int, customer_name string, city string, region string, segment string, credit_limit decimal(12,2), created_at timestamp, modified_at timestamp",
    "products": "product_id int, sku string, product_name string, brand string, category string, unit_price decimal(9,2), package string, created_at timestamp, modified_at timestamp",
    "orders": "order_id int, customer_id int, order_date date, status string, channel string, created_at timestamp, modified_at timestamp",
    "order_lines": "order_line_id int, order_id int, product_id int, quantity int, unit_price decimal(9,2), discount_pct decimal(5,2), modified_at timestamp",
    "deliveries": "delivery_id int, order_id int, planned_date date, actual_date date, carrier string, status string, modified_at timestamp",
}


class Database:
    """Rows in memory, read like an incremental source."""

    def __init__(self):
        d = date(2026, 6, 10)
        self.rows = {
            "customers": [(1, "Ann", "X", "west", "s", Decimal(1), at(1), at(1)), (2, "Bob", "Z", "east", "s", Decimal(1), at(1), at(1))],
            "products": [(7, "S7", "P", "B", "c", Decimal(4), "can", at(1), at(1))],
            "orders": [(10, 1, d, "placed", "direct", at(10), at(10)), (11, 9, d, "placed", "direct", at(10), at(10))],
            "order_lines": [(1, 10, 7, 3, Decimal("7.50"), Decimal(20), at(10))],
            "deliveries": [(5, 10, d, d, "c", "delivered", at(10))],
        }

    def read_increment(self, spark, table, mark):
        return since(spark.createDataFrame(self.rows[table], SCHEMAS[table]), "modified_at", mark)


def drop(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_pipeline_end_to_end(spark, tmp_path):
    lake, db = plan.Lake(spark, str(tmp_path / "lake"), str(tmp_path / "landing"), buckets=2), Database()
    landing = tmp_path / "landing" / "shipments"
    drop(landing, "a.csv", "shipment_id,order_id,distributor,ship_date,qty_cases,warehouse\n20260610001,10,D,2026-06-10,5,W\n")

    first = plan.refresh(lake, db)
    assert first["silver"]["rows_changed"] == "8" and first["silver"]["orders_ref_violations"] == "1"
    assert first["bronze_files_returns"]["rows"] == 0 and "returns_in" in first["silver"]
    assert first["gold"] == {
        "dim_customer": "2", "dim_product": "1", "dim_date": "1", "fact_sales": "1",
        "agg_daily_revenue": "1", "agg_delivery_sla": "1", "agg_distributor_shipments": "1",
    }
    assert lake.mark("orders") == at(10) and lake.mark("never") == datetime(1900, 1, 1)

    again = plan.refresh(lake, db)
    assert again["silver"]["rows_changed"] == "0" and again["gold"] == {"skipped": "silver unchanged"}
    assert again["bronze_sql_orders"]["rows"] == "0"

    db.rows["customers"][0] = (1, "Ann", "Y", "west", "s", Decimal(1), at(1), at(20))
    db.rows["orders"].append((12, 1, date(2026, 6, 25), "placed", "online", at(25), at(25)))
    db.rows["order_lines"].append((2, 12, 7, 12, Decimal("6.25"), Decimal(4), at(25)))
    third = plan.refresh(lake, db)
    assert third["silver"]["rows_changed"] == "3" and third["gold"]["dim_customer"] == "3"
    fact = lake.gold("fact_sales").read().join(lake.gold("dim_customer").read(), "customer_sk")
    assert sets(fact, "order_id", "city", "net_amount") == {(10, "X", Decimal("18.00")), (12, "Y", Decimal("72.00"))}
    assert lake.bronze("customers").read().count() == 3

    # A late row older than what silver knows changes nothing.
    late = spark.createDataFrame([(1, "Ann", "OLD", "west", "s", Decimal(1), at(1), at(15))], SCHEMAS["customers"])
    lake.bronze("customers").insert_versions(plan.stamp_load(late, "customers"), "modified_at")
    assert plan.refresh_silver(lake)["rows_changed"] == "0"

    tasks = {(r["task"], r["status"]) for r in lake.runs.read().collect()}
    assert ("gold", "succeeded") in tasks and ("quality_gates", "succeeded") in tasks


def test_silver_takes_newer_rows_only(spark, tmp_path):
    lake, day = plan.Lake(spark, str(tmp_path / "lake"), buckets=2), date(2026, 6, 10)

    def take(*orders):
        made = [(key, 1, day, status, "direct", at(1), moved) for key, status, moved in orders]
        lake.bronze("orders").insert_versions(plan.stamp_load(spark.createDataFrame(made, SCHEMAS["orders"]), "orders"), "modified_at")
        return plan.conform_entity(lake, "orders")

    assert take((10, "placed", at(9)), (10, "shipped", at(10)), (11, "placed", at(3))) == (2, 2)
    assert take((10, "late", at(5))) == (1, 0)
    assert take((10, "late", at(6)), (11, "shipped", at(12)), (12, "placed", at(1))) == (3, 2)
    assert sets(lake.silver("orders").read(), "order_id", "status") == {(10, "shipped"), (11, "shipped"), (12, "placed")}


def test_failed_gate_leaves_gold_as_it_was(spark, tmp_path):
    lake, db = plan.Lake(spark, str(tmp_path / "lake"), buckets=1), Database()
    plan.refresh(lake, db)
    db.rows["order_lines"] += [(9, 10, 77, 1, Decimal(1), Decimal(0), at(26))]
    with pytest.raises(GateFailure, match="product_sk"):
        plan.refresh(lake, db)
    assert lake.gold("fact_sales").read().count() == 1
    assert lake.runs.read().where("task = 'gold' and status = 'failed'").count() == 1


def test_gold_published_in_part_is_repaired(spark, tmp_path):
    lake, db = plan.Lake(spark, str(tmp_path / "lake"), buckets=1), Database()
    plan.refresh(lake, db)
    db.rows["order_lines"].append((3, 10, 7, 2, Decimal("5.00"), Decimal(0), at(26)))
    plan.refresh(lake, db)
    # As after a crash before the last tables were published.
    table = lake.gold("agg_daily_revenue")
    table.overwrite(table.read(0), note="older")
    assert "skipped" not in plan.refresh_gold(lake)
    assert sets(lake.gold("agg_daily_revenue").read(), "net_revenue") == {(Decimal("28.00"),)}
    assert plan.refresh_gold(lake) == {"skipped": "silver unchanged"}
