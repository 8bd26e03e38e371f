import random
from datetime import date
from decimal import Decimal

from strata.operators import conform
from tests.conftest import at, sets


def test_newest_version_is_the_one_with_the_greatest_time(spark):
    """Forty shuffled versions of nine meters, held against a plain maximum."""
    draw = random.Random(31)
    versions = [(f"meter-{draw.randrange(9)}", draw.random(), at(day)) for day in draw.sample(range(1, 29), 28)]
    versions += [("meter-x", 0.5, None), ("meter-x", 0.25, at(4, 6))]
    newest = conform.newest_version(spark.createDataFrame(versions, "id string, reading double, modified_at timestamp"), "id")
    latest = {}
    for meter, reading, moment in versions:
        if meter not in latest or (moment is not None and (latest[meter][1] is None or moment > latest[meter][1])):
            latest[meter] = (reading, moment)
    assert sets(newest, "id", "reading", "modified_at") == {(m, *found) for m, found in latest.items()}


def test_newest_version_breaks_ties_by_load_time_then_values(spark):
    rows = spark.createDataFrame(
        [(1, "a", at(1), at(3)), (1, "b", at(1), at(2)), (2, "x", at(1), at(1)), (2, "y", at(1), at(1))],
        "id int, name string, modified_at timestamp, _ingest_ts timestamp",
    )
    assert sets(conform.newest_version(rows, "id"), "id", "name") == {(1, "a"), (2, "y")}


def test_declared_types_are_taken_and_load_columns_stay(spark):
    """Of three gauges one has a weight that is no number and a day that does not exist."""
    rows = spark.createDataFrame(
        [("12.50", "2025-02-28", "spare", "north"), ("heavy", "2025-02-30", None, "south"), (None, None, "spare", None)],
        "weight string, seen string, remark string, _depot string",
    )
    wanted = {"seen": "date", "weight": "decimal(6,2)", "owner": "bigint"}
    out = conform.declare(rows, wanted)
    assert out.columns == ["seen", "weight", "owner", "_depot"] and "remark" not in out.columns
    assert sets(out, "seen", "weight", "owner", "_depot") == {
        (date(2025, 2, 28), Decimal("12.50"), None, "north"),
        (None, None, None, "south"),
        (None, None, None, None),
    }
    assert conform.misfits(rows, {"weight": "decimal(6,2)"}).count() == 1


def test_rows_without_a_parent_are_found_and_counted(spark):
    """Berths 500 to 519, of which every third has a pier; two berths name none."""
    berths = spark.createDataFrame([(n, 7000 + n) for n in range(500, 520)] + [(900, None), (901, None)], "berth int, pier int")
    piers = spark.createDataFrame([(7000 + n,) for n in range(500, 520, 3)] * 2 + [(1,)], "pier int")
    lost = {(n,) for n in range(500, 520) if (n - 500) % 3} | {(900,), (901,)}
    assert sets(conform.orphans(berths, piers, "pier"), "berth") == lost
    assert conform.orphan_count(berths, piers, "pier", "lost").first()[0] == len(lost)
    assert conform.orphan_count(berths.limit(0), piers, "pier", "lost").first()[0] == 0
