from strata.operators import merge
from tests.conftest import at, sets

ORDERS = "order_id int, status string, modified_at timestamp, _ingest_ts timestamp"


def orders(spark, *values):
    return spark.createDataFrame(list(values), ORDERS)


def test_upsert_updates_inserts_and_ignores_replays(spark):
    old = orders(spark, (1, "placed", at(1), at(1)))
    assert merge.upsert_changes(old, orders(spark, (1, "placed", at(1), at(9))), "order_id").count() == 0
    new = orders(spark, (1, "delivered", at(2), at(2)), (2, "placed", at(2), at(2)))
    state = merge.upsert_state(old, new, "order_id")
    assert sets(state, "order_id", "status") == {(1, "delivered"), (2, "placed")}
    counts = merge.count_ops(merge.upsert_changes(old, new, "order_id")).first()
    assert tuple(counts) == (1, 1, 2)


def test_a_newer_time_is_a_change_and_metadata_follows(spark):
    old = orders(spark, (1, "placed", at(1), at(1)))
    new = orders(spark, (1, "placed", at(2), at(5)))
    assert sets(merge.upsert_state(old, new, "order_id"), "_ingest_ts") == {(at(5),)}


def test_null_is_a_value(spark):
    old = orders(spark, (1, None, at(1), at(1)), (2, "x", at(1), at(1)))
    same = merge.upsert_changes(old, old, "order_id")
    assert same.count() == 0
    swapped = orders(spark, (1, "x", at(1), at(1)), (2, None, at(1), at(1)))
    assert merge.upsert_changes(old, swapped, "order_id").count() == 2


def test_change_feed_has_images_and_deletes(spark):
    before = orders(spark, (1, "placed", at(1), at(1)), (3, "gone", at(1), at(1)), (4, None, at(1), None))
    after = orders(spark, (1, "shipped", at(2), at(2)), (2, "new", at(2), at(2)), (4, None, at(1), None))
    feed = merge.change_feed(before, after, "order_id")
    assert sets(feed, "_change_type", "order_id", "status") == {
        ("update_preimage", 1, "placed"),
        ("update_postimage", 1, "shipped"),
        ("insert", 2, "new"),
        ("delete", 3, "gone"),
    }


def test_versions_are_kept_once(spark):
    keys = ["order_id", "modified_at"]
    first = orders(spark, (1, "placed", at(1), at(1)), (1, "placed", at(1), at(1)))
    loaded = merge.unseen_versions(first.limit(0), first, keys)
    assert loaded.count() == 1
    assert merge.unseen_versions(loaded, first, keys).count() == 0
    later = orders(spark, (1, "placed", at(1), at(2)), (1, "shipped", at(2), at(2)))
    assert sets(merge.unseen_versions(loaded, later, keys), "status") == {("shipped",)}
