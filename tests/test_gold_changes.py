"""Aggregates that follow changes against those built anew."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import gold_changes as gold
from strata.operators import conform, merge, star
from strata.operators.deltas import ROWS, Sums, signed, stated
from strata.plans import gold_change_queries
from strata.plans.staging import Staging
from tests.conftest import SMALL, at, plan_text, sets

LINE = "order_line_id int, order_id int, product_id int, quantity int, unit_price decimal(9,2), discount_pct decimal(5,2)"
ORDER = "order_id int, customer_id int, order_date date, status string, channel string"
CUSTOMER = (
    "customer_sk bigint, customer_id int, customer_name string, city string, region string, segment string,"
    "credit_limit decimal(12,2), valid_from timestamp, valid_to timestamp, is_current boolean"
)
PRODUCT = "product_sk bigint, product_id int, brand string"


def world(draw):
    """One state of all tables as dicts by key."""
    day = lambda: date(2026, 6, 1) + timedelta(days=draw.randrange(12))
    customers = {}
    for c in range(1, 7):
        cuts = sorted(draw.sample(range(1, 13), draw.randrange(1, 4)))
        for start, end in zip(cuts, [*cuts[1:], None]):
            customers[c * 100 + start] = (c * 100 + start, c, f"c{c}", "x", draw.choice(["north", "south", None]), "s", Decimal(1), at(start), at(end) if end else None, end is None)
    return {
        "customers": customers,
        "products": {p: (p, p, draw.choice(["Ale", "Stout", None])) for p in range(1, 6)},
        "orders": {o: (o, draw.randrange(1, 8), day(), draw.choice(["placed", "placed", "cancelled", None]), "web") for o in range(1, 25)},
        "lines": {i: (i, draw.randrange(1, 27), draw.randrange(1, 7), draw.choice([None, 1, 5, 7]), draw.choice([Decimal("1.25"), None]), Decimal(draw.choice([0, 10]))) for i in range(1, 70)},
    }


def changed(draw, state):
    """Another state: some rows gone, some new, some different."""
    other = world(draw)
    out = {}
    for name, rows in state.items():
        share = draw.choice([0, 0.2, 0.5])
        mixed = {k: (other[name].get(k, v) if draw.random() < share else v) for k, v in rows.items()}
        mixed = {k: v for k, v in mixed.items() if draw.random() > share / 3}
        out[name] = mixed | {k: v for k, v in other[name].items() if k not in rows and draw.random() < share}
    return out


def tables(spark, state):
    frame = lambda name, schema: spark.createDataFrame(list(state[name].values()), schema).coalesce(1)
    return gold.SalesTables(frame("lines", LINE), frame("orders", ORDER), frame("customers", CUSTOMER), frame("products", PRODUCT))


def kept(frame):
    """The rows as a table of their own, so that what follows does not compute them again."""
    return frame.sparkSession.createDataFrame(frame.collect(), frame.schema).coalesce(1)


def rebuilt(t):
    fact = star.sales_fact(t.lines, t.orders, t.customers, t.products, ["region"], ["brand"])
    return star.daily_revenue(fact, t.customers, t.products)


FIGURES = ("order_date", "brand", "region", "net_revenue", "units_sold", "orders")


@pytest.mark.parametrize("seed", range(2))
def test_revenue_follows_all_changes(spark, seed):
    draw = random.Random(seed)
    first = world(draw)
    second = changed(draw, first)
    old, new = tables(spark, first), tables(spark, second)
    feeds = [kept(signed(merge.change_feed(getattr(old, n), getattr(new, n), key))) for n, key in (("lines", "order_line_id"), ("orders", "order_id"), ("customers", "customer_sk"), ("products", "product_id"))]
    sales = kept(gold.sales_by_order(old))
    assert sets(gold.daily_revenue(gold.DAILY_SALES.over(sales)), *FIGURES) == sets(rebuilt(old), *FIGURES)
    below = kept(gold.SALES_BY_ORDER.changes(sales, gold.sales_changes(old, new, *feeds)))
    daily = gold.DAILY_SALES.over(sales)
    changes = gold.DAILY_SALES.changes(daily, gold.DAILY_SALES.over_changes(below))
    after = gold.DAILY_SALES.applied(daily, changes)
    got = gold.daily_revenue(after).collect()
    assert {tuple(r[c] for c in FIGURES) for r in got} == sets(rebuilt(new), *FIGURES) and len(got) == len({r[:3] for r in got})
    assert sets(gold.SALES_BY_ORDER.applied(sales, below), *sales.columns) == sets(gold.sales_by_order(new), *sales.columns)


def test_a_customer_who_moves_takes_the_orders_along(spark):
    state = {
        "customers": {1: (1, 7, "c", "x", "north", "s", Decimal(1), at(1), None, True)},
        "products": {1: (1, 1, "Ale")},
        "orders": {5: (5, 7, date(2026, 6, 3), "placed", "web"), 6: (6, 7, date(2026, 6, 4), "placed", "web")},
        "lines": {1: (1, 5, 1, 2, Decimal("1.50"), Decimal(0)), 2: (2, 6, 1, 1, Decimal("1.50"), Decimal(0))},
    }
    moved = state | {"customers": {1: (*state["customers"][1][:4], "south", *state["customers"][1][5:])}}
    old, new = tables(spark, state), tables(spark, moved)
    none = lambda frame: signed(merge.change_feed(frame, frame, frame.columns[0]))
    feed = signed(merge.change_feed(old.customers, new.customers, "customer_sk"))
    delta = gold.sales_changes(old, new, none(old.lines), none(old.orders), feed, none(old.products))
    delta = kept(delta)
    assert sets(delta, "order_id", "region", ROWS, "net") == {
        (5, "north", -1, Decimal("-3.00")), (5, "south", 1, Decimal("3.00")),
        (6, "north", -1, Decimal("-1.50")), (6, "south", 1, Decimal("1.50")),
    }
    daily = gold.DAILY_SALES.over(gold.sales_by_order(old))
    below = gold.SALES_BY_ORDER.changes(gold.sales_by_order(old), delta)
    changes = gold.DAILY_SALES.changes(daily, gold.DAILY_SALES.over_changes(below))
    assert sets(changes, "region", "_op") == {("north", "delete"), ("south", "insert")}
    assert sets(gold.DAILY_SALES.applied(daily, changes), "region", "orders") == {("south", 1)}


def test_sums_of_nothing_and_groups_without_rows(spark):
    table = Sums(["g"], {"v": (lambda: F.col("x"), "bigint")})
    rows = spark.createDataFrame([("a", 1), ("a", None), ("b", None), (None, 4)], "g string, x int")
    state = table.of(stated(rows))
    assert sets(state.select("g", ROWS, table.value("v").alias("v")), "g", ROWS, "v") == {("a", 2, 1), ("b", 1, None), (None, 1, 4)}
    feed = spark.createDataFrame([("a", 1, -1), ("b", 0, 1), (None, 4, -1), ("c", None, 1), ("c", None, -1)], "g string, x int, _weight bigint")
    changes = table.changes(state, table.of(feed))
    assert sets(changes, "g", "_op") == {("a", "update"), ("b", "update"), (None, "delete")}
    after = table.applied(state, changes)
    assert sets(after.select("g", ROWS, table.value("v").alias("v")), "g", ROWS, "v") == {("a", 1, None), ("b", 2, 0)}


def test_sla_and_volume_follow(spark):
    d = date(2026, 6, 1)
    rows = lambda *values: spark.createDataFrame(list(values), "delivery_id int, planned_date date, actual_date date, carrier string")
    old = rows((1, d, None, "c"), (2, d, d, "c"), (3, d, d + timedelta(3), "x"))
    new = rows((1, d, d + timedelta(1), "c"), (2, d, d, "c"))
    change = gold.DELIVERIES.of(gold.took_place(signed(merge.change_feed(old, new, "delivery_id"))))
    state = gold.DELIVERIES.of(stated(gold.took_place(old)))
    after = gold.delivery_sla(gold.DELIVERIES.applied(state, gold.DELIVERIES.changes(state, change)))
    names = ("planned_date", "carrier", "deliveries", "on_time", "avg_delay_days", "on_time_rate")
    assert sets(after, *names) == sets(star.delivery_sla(new), *names) == {(d, "c", 2, 1, 0.5, 0.5)}

    ship = lambda *values: spark.createDataFrame(list(values), "shipment_id int, ship_date date, distributor string, warehouse string, qty_cases int")
    old = ship((1, d, "a", "w1", 5), (2, d, "a", "w2", 5), (3, d, "b", None, 1))
    new = ship((1, d, "a", "w1", 9), (2, d, "a", "w1", 5), (3, d, "b", None, None), (4, d, "b", "w9", None))
    lower = gold.BY_WAREHOUSE.of(stated(old))
    below = gold.BY_WAREHOUSE.changes(lower, gold.BY_WAREHOUSE.of(signed(merge.change_feed(old, new, "shipment_id"))))
    upper = gold.SHIPMENTS.over(lower)
    after = gold.distributor_volume(gold.SHIPMENTS.applied(upper, gold.SHIPMENTS.changes(upper, gold.SHIPMENTS.over_changes(below))))
    names = ("ship_date", "distributor", "shipments", "cases_shipped", "warehouses_used")
    assert sets(after, *names) == sets(star.distributor_volume(new), *names)


def test_changes_are_met_by_keys_only(spark):
    draw = random.Random(1)
    t = tables(spark, world(draw))
    none = lambda frame: signed(merge.change_feed(frame, frame, frame.columns[0]))
    plan = plan_text(gold.sales_changes(t, t, none(t.lines), none(t.orders), none(t.customers), none(t.products)))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_feed_of_placed_states_is_the_feed(spark):
    """Rows that lie by their identity are joined as they lie; nulls in it and repeated keys count as before."""
    schema = "id int, part string, n int"
    rows = [(i if i % 7 else None, "a" if i % 3 else None, i % 4) for i in range(60)] + [(5, "a", 9), (5, "a", 1)]
    state = spark.createDataFrame(rows, schema).repartition(4, "id", "part")
    before = state.where("n <> 3 or n is null").withColumn("n", F.when(F.col("part") == "a", F.col("n") + 1).otherwise(F.col("n")))
    after = state.where("n <> 0")
    for identity in ("id", ["id", "part"]):
        wanted = merge.change_feed(before, after, identity)
        found = merge.change_feed(before, after, identity, placed=True)
        assert sorted(found.collect(), key=str) == sorted(wanted.collect(), key=str), identity
    once = conform.newest_version(state.where("id is not null"), "id", "n")
    shuffled = plan_text(merge.change_feed(once.where("n <> 3"), once, "id"))
    assert "Exchange hashpartitioning(coalesce(_pre_0" in shuffled
    assert "Exchange hashpartitioning(_pre_0" not in plan_text(merge.change_feed(once.where("n <> 3"), once, "id", placed=True))


def test_uncut_state_gives_the_same_changes(spark):
    sums = Sums(["k", "part"], {"n": (lambda: F.col("n"), "bigint")})
    rows = [(i % 9 if i % 5 else None, "a" if i % 2 else None, i) for i in range(70)]
    state = sums.of(stated(spark.createDataFrame(rows, "k int, part string, n int")))
    change = sums.of(spark.createDataFrame([(k, p, n, w) for (k, p, n), w in zip(rows[::3], [-1, 1, 2] * 9)] + [(99, "new", 4, 1)], "k int, part string, n int, _weight bigint"))
    cut, whole = sums.changes(state, change), sums.changes(state, change, cut=False)
    assert sorted(whole.collect(), key=str) == sorted(cut.collect(), key=str) and whole.count() > 5
    assert "LeftSemi" in plan_text(cut) and "LeftSemi" not in plan_text(whole)


def test_followed_revenue_works_lines_out_once(spark, monkeypatch):
    """Only the pairs of states look at the lines; the old state comes from them."""
    seen = []
    real = gold_change_queries.settled
    monkeypatch.setattr(gold_change_queries, "settled", lambda rows, name: (seen.append((name, "l_extendedprice" in rows._jdf.queryExecution().analyzed().toString())), real(rows, name))[1])
    gold_change_queries.agg_daily_revenue_followed(Staging(spark, SMALL))
    assert [name for name, lines in seen if lines] == ["pairs-lines"]
