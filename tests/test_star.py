import re
from datetime import date
from decimal import Decimal

import pytest

from strata.operators import star
from strata.plans import staging, star_queries
from tests.conftest import SMALL, at, plan_text, sets

LINE = "order_line_id int, order_id int, product_id int, quantity int, unit_price decimal(9,2), discount_pct decimal(5,2)"


@pytest.fixture()
def world(spark):
    """Two shops, of which one changes hands twice; four brands, one without sales."""
    history = spark.createDataFrame(
        [
            (31, "Kiosk Nord", "Aarhus", "north", "kiosk", Decimal(250), at(3, 0, 2), at(14, 0, 2), False),
            (31, "Kiosk Nord", "Odense", "isles", "kiosk", Decimal(250), at(14, 0, 2), at(2, 0, 4), False),
            (31, "Kiosk Nord", "Odense", "isles", "chain", Decimal(900), at(2, 0, 4), None, True),
            (44, "Bar Sud", "Nice", "coast", "bar", Decimal(75), at(20, 0, 3), None, True),
        ],
        "customer_id int, customer_name string, city string, region string, segment string,"
        "credit_limit decimal(12,2), valid_from timestamp, valid_to timestamp, is_current boolean",
    )
    products = spark.createDataFrame(
        [
            (601, "LM-05", "Lime half", "Lime", "soft", Decimal("1.25"), "glass"),
            (602, "OA-10", "Oat one", "Oat", "plant", Decimal("3.10"), "carton"),
            (603, "NO-01", "None yet", "Nova", "soft", Decimal("2.00"), "can"),
        ],
        "product_id int, sku string, product_name string, brand string, category string,"
        "unit_price decimal(9,2), package string",
    )
    orders = spark.createDataFrame(
        [
            (7001, 31, date(2026, 2, 13), "delivered", "phone"),
            (7002, 31, date(2026, 2, 14), "placed", "web"),
            (7003, 31, date(2026, 4, 9), "delivered", "web"),
            (7004, 44, date(2026, 3, 28), "delivered", "phone"),
            (7005, 44, date(2026, 4, 9), "cancelled", "web"),
            (7006, 44, date(2026, 1, 30), "delivered", "web"),
        ],
        "order_id int, customer_id int, order_date date, status string, channel string",
    )
    lines = spark.createDataFrame(
        [
            (1, 7001, 601, 8, Decimal("1.25"), Decimal("0.00")),
            (2, 7001, 602, 3, Decimal("3.10"), Decimal("50.00")),
            (3, 7002, 601, 24, Decimal("1.25"), Decimal("0.00")),
            (4, 7003, 602, 6, Decimal("3.10"), Decimal("25.00")),
            (5, 7004, 601, 12, Decimal("1.20"), Decimal("0.00")),
            (6, 7004, 699, 1, Decimal("9.99"), Decimal("0.00")),
            (7, 7005, 602, 40, Decimal("3.10"), Decimal("0.00")),
            (8, 7006, 601, 2, Decimal("1.25"), Decimal("0.00")),
            (9, 7777, 601, 5, Decimal("1.25"), Decimal("0.00")),
        ],
        LINE,
    )
    return star.customer_dimension(history), star.product_dimension(products), orders, lines


def test_calendar_has_no_gap(world):
    days = star.calendar_dimension(world[2])
    assert days.count() == 70 and days.select("date").distinct().count() == 70
    assert star.calendar_dimension(world[2].limit(0)).count() == 0
    sunday = days.where("date = date '2026-03-01'").first()
    assert (sunday["date_key"], sunday["day_of_week"], sunday["is_weekend"]) == (20260301, 1, True)


def test_fact_takes_the_version_of_the_order_day(world):
    customers, products, orders, lines = world
    fact = star.sales_fact(lines, orders, customers, products).join(
        customers.select("customer_sk", "city", "segment"), "customer_sk"
    )
    assert sets(fact, "order_line_id", "city", "segment", "net_amount") == {
        (1, "Aarhus", "kiosk", Decimal("10.00")),
        (2, "Aarhus", "kiosk", Decimal("4.65")),
        (3, "Odense", "kiosk", Decimal("30.00")),
        (4, "Odense", "chain", Decimal("13.95")),
        (5, "Nice", "bar", Decimal("14.40")),
        (6, "Nice", "bar", Decimal("9.99")),
        (7, "Nice", "bar", Decimal("124.00")),
        (8, "Nice", "bar", Decimal("2.50")),
    }
    assert sets(fact.where("product_sk is null"), "order_line_id") == {(6,)}


def test_fact_brings_attributes_along(world):
    customers, products, orders, lines = world
    wanted = ["customer_id", "city", "region", "valid_from"]
    fact = star.sales_fact(lines, orders, customers, products, wanted, ["brand"])
    plain = star.sales_fact(lines, orders, customers, products)
    joined = plain.drop("customer_id").join(customers.select("customer_sk", *wanted), "customer_sk", "left")
    joined = joined.join(products.select("product_sk", "brand"), "product_sk", "left")
    names = ["order_line_id", "customer_sk", "net_amount", *wanted, "brand"]
    assert sets(fact, *names) == sets(joined, *names) and len(fact.columns) == len(plain.columns) + 5
    days = ["order_date", "brand", "region", "net_revenue", "units_sold", "orders"]
    assert sets(star.daily_revenue(fact, customers, products), *days) == sets(star.daily_revenue(plain, customers, products), *days)


def test_version_starting_and_ending_on_the_day(spark, world):
    """A version that starts after midnight does not hold for orders of that day."""
    _, products, orders, lines = world
    history = spark.createDataFrame(
        [
            (31, "a", "A", "r", "s", Decimal(1), at(3, 0, 2), at(13, 8, 2), False),
            (31, "a", "B", "r", "s", Decimal(1), at(13, 8, 2), at(13, 9, 2), False),
            (31, "a", "E", "r", "s", Decimal(1), at(13, 9, 2), at(13, 9, 2), False),
            (31, "a", "C", "r", "s", Decimal(1), at(13, 9, 2), at(9, 0, 4), False),
            (31, "a", "D", "r", "s", Decimal(1), at(9, 0, 4), None, True),
        ],
        "customer_id int, customer_name string, city string, region string, segment string,"
        "credit_limit decimal(12,2), valid_from timestamp, valid_to timestamp, is_current boolean",
    )
    customers = star.customer_dimension(history)
    fact = star.sales_fact(lines, orders, customers, products).join(
        customers.select("customer_sk", "city"), "customer_sk"
    )
    assert sets(fact.where("order_id <> 7002"), "order_id", "city") == {(7001, "A"), (7003, "D")}


def test_revenue(world):
    customers, products, orders, lines = world
    fact = star.sales_fact(lines, orders, customers, products)
    daily = star.daily_revenue(fact, customers, products)
    assert sets(daily, "order_date", "brand", "region", "net_revenue", "units_sold", "orders") == {
        (date(2026, 2, 13), "Lime", "north", Decimal("10.00"), 8, 1),
        (date(2026, 2, 13), "Oat", "north", Decimal("4.65"), 3, 1),
        (date(2026, 2, 14), "Lime", "isles", Decimal("30.00"), 24, 1),
        (date(2026, 4, 9), "Oat", "isles", Decimal("13.95"), 6, 1),
        (date(2026, 3, 28), "Lime", "coast", Decimal("14.40"), 12, 1),
        (date(2026, 1, 30), "Lime", "coast", Decimal("2.50"), 2, 1),
    }


def test_sla_ignores_open_deliveries(spark):
    d = date(2026, 6, 1)
    rows = spark.createDataFrame(
        [(d, d, "c"), (d, date(2026, 6, 3), "c"), (d, None, "c"), (d, None, "open")],
        "planned_date date, actual_date date, carrier string",
    )
    assert [tuple(r)[1:] for r in star.delivery_sla(rows).collect()] == [("c", 2, 1, 1.0, 0.5)]


def test_distributor_volume(spark):
    rows = spark.createDataFrame(
        [(date(2026, 6, 1), "a", "w1", 20), (date(2026, 6, 1), "a", "w2", 40), (date(2026, 6, 1), "b", "w1", 10)],
        "ship_date date, distributor string, warehouse string, qty_cases int",
    )
    assert sets(star.distributor_volume(rows), "distributor", "shipments", "cases_shipped", "warehouses_used") == {
        ("a", 2, 60, 2),
        ("b", 1, 10, 1),
    }


def test_lines_of_a_task_are_bounded(spark, monkeypatch):
    """Joins by order take as many partitions as the table has lines for, and give the same rows."""
    s = staging.Staging(spark, SMALL)
    rows = sorted(star_queries.agg_daily_revenue(s).collect(), key=str)
    lines = s.raw("lineitem").count()
    assert s.line_parts is None
    monkeypatch.setattr(staging, "LINES_PER_TASK", -(-lines // 13))
    many = staging.Staging(spark, SMALL)
    assert many.line_parts == 13 > spark.sparkContext.defaultParallelism
    bounded = star_queries.agg_daily_revenue(many)
    assert re.findall(r"hashpartitioning\(order_id#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan_text(bounded)) == ["13", "13"]
    assert sorted(bounded.collect(), key=str) == rows
