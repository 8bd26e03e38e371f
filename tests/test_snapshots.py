import random
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException

from strata.operators.snapshots import SnapshotTable, retention_candidates
from tests.conftest import at, plan_text, sets

SCHEMA = "id bigint, name string, modified_at timestamp"


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


@pytest.fixture()
def table(spark, folder):
    return SnapshotTable(spark, f"{folder}/t", "id", buckets=4)


def test_empty_table(table):
    assert not table.exists() and table.version() is None and table.commits().count() == 0
    with pytest.raises(ValueError):
        table.read()


def test_upsert_rewrites_only_changed_buckets(spark, table):
    first = rows(spark, *[(i, "a", at(1)) for i in range(40)])
    assert table.upsert(first) == 40
    assert table.upsert(first) == 0 and table.version() == 0
    assert table.upsert(rows(spark, (7, "b", at(2)), (100, "n", at(2)))) == 2
    commit = table.commits().where("version = 1").first()
    assert (commit["inserted"], commit["updated"]) == (1, 1)
    assert '"0-' in commit["layout"] and "[" in commit["layout"], "untouched buckets stay with the first version"
    assert table.read().count() == 41
    assert table.read(0).count() == 40
    feed = table.changes_between(0, 1)
    assert sets(feed, "_change_type", "id") == {
        ("update_preimage", 7),
        ("update_postimage", 7),
        ("insert", 100),
    }


def test_scd2_is_one_commit_and_replay_changes_nothing(spark, table):
    table.scd2(rows(spark, (1, "a", at(1)), (2, "a", at(1))), ["name"])
    batch = rows(spark, (1, "b", at(2)), (3, "c", at(2)))
    assert table.scd2(batch, ["name"]) == 2
    assert table.scd2(batch, ["name"]) == 0
    assert table.version() == 1
    assert table.read().count() == 4
    assert sets(table.read().where("is_current"), "id", "name") == {(1, "b"), (2, "a"), (3, "c")}


def test_insert_versions_reports_rows_and_latest(spark, table):
    assert table.insert_versions(rows(spark, (1, "a", at(1)), (1, "a", at(1))), "modified_at") == (1, at(1))
    again = rows(spark, (1, "a", at(1)), (1, "b", at(3)), (2, "c", at(2)))
    assert table.insert_versions(again, "modified_at") == (2, at(3))
    assert table.insert_versions(again, "modified_at") == (0, None)
    assert table.read().count() == 3
    assert table.rows_after(1).count() == 2


def test_older_versions_are_skipped_by_the_scan(spark, table):
    table.insert_versions(rows(spark, (1, "a", at(1)), (2, "b", at(9))), "modified_at")
    known = table.known_since(rows(spark, (1, "a", at(8)), (3, "c", None)), "modified_at")
    assert "GreaterThanOrEqual(modified_at" in plan_text(known)
    mixed = rows(spark, (1, "a", at(1)), (2, "b", at(9)), (3, "c", None))
    assert table.insert_versions(mixed, "modified_at") == (1, None)
    assert table.known_since(rows(spark, (3, "c", None)), "modified_at").count() == 1


def test_update_delete_restore_compact(spark, table):
    table.overwrite(rows(spark, (1, "a", at(1)), (2, "b", at(1)), (3, None, at(1))))
    assert table.update_where("name = 'a'", {"name": "'z'"}) == 1
    assert table.delete_where("name = 'b'") == 1
    assert table.delete_where("name = 'missing'") == 0
    assert sets(table.read(), "id", "name") == {(1, "z"), (3, None)}
    table.compact()
    table.restore(1)
    assert sets(table.read(), "id", "name") == {(1, "z"), (2, "b"), (3, None)}
    assert [r["operation"] for r in table.commits().orderBy("version").collect()] == [
        "overwrite", "update", "delete", "compact", "restore",
    ]


def test_overwrite_replaces_schema_and_may_read_itself(spark, table):
    table.overwrite(rows(spark, (1, "a", at(1))))
    table.overwrite(table.read().selectExpr("id", "id + 1 as other"))
    assert table.read().columns == ["id", "other"] and table.read(0).columns[1] == "name"


def test_unpublished_rows_are_invisible(spark, table):
    table.overwrite(rows(spark, (1, "a", at(1))))
    staged = table.stage(rows(spark, (2, "b", at(1))))
    assert table.version() == 0 and sets(table.read(), "id") == {(1,)}
    assert sets(table.staged_rows(staged), "id") == {(2,)}
    table.publish(staged, "overwrite")
    assert sets(table.read(), "id") == {(2,)}
    with pytest.raises(AnalysisException):
        table.publish(staged, "overwrite")


def test_retention_names_replaced_versions(spark, table):
    for day in (1, 2, 20):
        table.overwrite(rows(spark, (day, "a", at(1))), at=datetime(2026, 1, day))
    due = retention_candidates(table.commits(), datetime(2026, 1, 21))
    assert sets(due, "version") == {(0,)}
    assert retention_candidates(table.commits(), datetime(2026, 1, 21), 0).count() == 2


def test_a_stale_object_is_refused_and_harms_nothing(spark, table):
    table.overwrite(rows(spark, (1, "a", at(1))))
    stale = SnapshotTable(spark, table.path, "id", buckets=4)
    assert stale.version() == 0
    table.upsert(rows(spark, *[(i, "b", at(2)) for i in range(50)]))
    with pytest.raises(RuntimeError, match="version 1"):
        stale.overwrite(rows(spark, (9, "z", at(3))))
    assert table.read().count() == 50 and SnapshotTable(spark, table.path, "id", buckets=4).read().count() == 50


def test_an_unfinished_attempt_leaves_no_trace(spark, table):
    table.overwrite(rows(spark, *[(i, "a", at(1)) for i in range(20)]))
    table.stage(rows(spark, (99, "lost", at(2))))
    assert table.upsert(rows(spark, (3, "b", at(2)))) == 1
    assert table.read().count() == 20 and table.read().where("id = 99").count() == 0


def test_the_key_can_not_be_assigned(spark, table):
    table.overwrite(rows(spark, *[(i, "a", at(1)) for i in range(10)]))
    with pytest.raises(ValueError, match="id"):
        table.update_where("id < 5", {"ID": "id + 100"})
    assert table.read().count() == 10


def test_progress_is_carried_over_by_every_commit(spark, table):
    table.upsert(rows(spark, (1, "a", at(1)), (2, "a", at(1))), note="7")
    table.update_where("id = 1", {"name": "'x'"})
    table.delete_where("id = 2")
    table.compact()
    table.restore(0)
    assert table.note() == "7" and SnapshotTable(spark, table.path, "id", buckets=4).note() == "7"


def test_repeated_update_keys_are_refused(spark, table):
    with pytest.raises(ValueError, match="several updates"):
        table.upsert(rows(spark, (1, "a", at(1)), (1, "b", at(1))))
    table.upsert(rows(spark, (1, "a", at(1))))
    with pytest.raises(ValueError, match="several updates"):
        table.upsert(rows(spark, (1, "b", at(2)), (1, "c", at(2))))


def test_feed_by_row_identity_and_over_schema_changes(spark, folder):
    table = SnapshotTable(spark, f"{folder}/h", "id", buckets=2, identity=["id", "valid_from"])
    table.scd2(rows(spark, (1, "a", at(1)), (2, "a", at(1))), ["name"])
    table.scd2(rows(spark, (1, "b", at(2))), ["name"])
    table.scd2(rows(spark, (1, "c", at(3))), ["name"])
    feed = [r["_change_type"] for r in table.changes_between(1, 2).collect()]
    assert sorted(feed) == ["insert", "update_postimage", "update_preimage"]
    wide = SnapshotTable(spark, f"{folder}/w", "id")
    wide.overwrite(rows(spark, (1, "a", at(1)), (2, "b", at(1))))
    wide.overwrite(spark.createDataFrame([(1, at(1), 5), (2, at(1), None)], "id bigint, modified_at timestamp, extra int"))
    images = {(r["_change_type"], r["id"], r["name"], r["extra"]) for r in wide.changes_between(0, 1).collect()}
    assert ("update_postimage", 1, None, 5) in images and ("update_preimage", 1, "a", None) in images and len(images) == 4


def test_retention_spares_what_is_still_read(spark, table):
    table.overwrite(rows(spark, *[(i, "a", at(1)) for i in range(40)]), at=at(1))
    table.upsert(rows(spark, (1, "b", at(2))), at=at(2))
    assert retention_candidates(table.commits(), at(20), 24).count() == 0, "the newest version reads rows of the first"
    table.compact(at=at(3))
    assert sorted(r["version"] for r in retention_candidates(table.commits(), at(20), 24).collect()) == [0, 1]


def test_changes_of_every_version_in_one_pass(spark, folder):
    """Held against the states of neighbouring versions, over edits, a purge, a restore and a compaction."""
    draw = random.Random(4)
    table = SnapshotTable(spark, f"{folder}/t", "id", buckets=5)
    table.upsert(rows(spark, *[(i, "a", at(1)) for i in range(30)], (None, "null key", at(1))), at=at(1))
    for day in range(2, 6):
        some = draw.sample(range(40), 9)
        table.upsert(rows(spark, *[(i, draw.choice("abc"), at(day)) for i in some], (None, f"n{day // 2}", at(2))), at=at(day))
    table.delete_where("id % 4 = 1", at=at(6))
    table.restore(2, at=at(7))
    table.compact(at=at(8))
    table.update_where("name = 'b'", {"name": "'B'"}, at=at(9))
    last = table.version()
    kept = ("_commit_version", "_change_type", "id", "name", "modified_at")

    def pairs(since, until):
        out = []
        for v in range(since, until + 1):
            if v == 0:
                out += [(0, "insert", *r) for r in table.read(0).collect()]
            else:
                out += [tuple(r[c] for c in kept) for r in table.changes_between(v - 1, v).collect()]
        return sorted(out, key=str)

    for since, until in ((0, last), (3, last), (1, 6), (last, last)):
        feed = table.changes(since, until)
        assert sorted((tuple(r[c] for c in kept) for r in feed.collect()), key=str) == pairs(since, until)
    times = {(r["_commit_version"], r["_commit_timestamp"].day) for r in table.changes(0).collect()}
    assert {(0, 1), (last, 9)} <= times and table.changes(last + 1).count() == 0


def test_a_null_key_is_a_key(spark, table):
    first = rows(spark, (None, "a", at(1)), (1, "a", at(1)))
    assert table.upsert(first) == 2 and table.upsert(first) == 0
    assert table.upsert(rows(spark, (None, "b", at(2)))) == 1
    assert sets(table.read(), "id", "name") == {(None, "b"), (1, "a")} and table.read().count() == 2
    past = rows(spark, (None, "b", at(2)), (2, "c", at(2)))
    assert table.insert_versions(past, "modified_at")[0] == 1
    assert table.insert_versions(past, "modified_at")[0] == 0


def test_columns_of_the_source_are_added(spark, folder):
    wide = lambda *values: spark.createDataFrame(list(values), "id bigint, name string, modified_at timestamp, region string")
    table = SnapshotTable(spark, f"{folder}/u", "id", buckets=4)
    table.upsert(rows(spark, *[(i, "a", at(1)) for i in range(12)]))
    assert table.upsert(wide((3, "a", at(1), None), (4, "a", at(1), "north"), (20, "n", at(2), "south"))) == 2
    assert table.read().columns == ["id", "name", "modified_at", "region"]
    assert sets(table.read().where("region is not null"), "id", "region") == {(4, "north"), (20, "south")} and table.read().count() == 13
    bronze = SnapshotTable(spark, f"{folder}/b", "id", buckets=4)
    bronze.insert_versions(rows(spark, (1, "a", at(1))), "modified_at")
    assert bronze.insert_versions(wide((1, "a", at(1), "x"), (1, "b", at(2), "y")), "modified_at")[0] == 1
    assert sets(bronze.read(), "id", "region") == {(1, None), (1, "y")}
    history = SnapshotTable(spark, f"{folder}/h", "id", buckets=4)
    history.scd2(rows(spark, (1, "a", at(1)), (2, "a", at(1))), ["name"])
    assert history.scd2(wide((1, "a", at(2), "north")), ["name", "region"]) == 1
    assert sets(history.read(), "id", "region", "is_current") == {(1, None, False), (1, "north", True), (2, None, True)}


def test_history_refuses_repeated_keys_and_late_rows(spark, table):
    table.scd2(rows(spark, (1, "a", at(5))), ["name"])
    with pytest.raises(ValueError, match="several updates"):
        table.scd2(rows(spark, (1, "b", at(6)), (1, "c", at(7))), ["name"])
    assert table.scd2(rows(spark, (1, "b", at(3))), ["name"]) == 0
    assert table.scd2(rows(spark, (1, "b", at(5))), ["name"]) == 0
    assert sets(table.read(), "id", "name", "is_current") == {(1, "a", True)}
    assert table.scd2(rows(spark, (1, "b", at(6)), (None, "n", at(6))), ["name"]) == 2
    assert table.scd2(rows(spark, (None, "n", at(7))), ["name"]) == 0
    assert table.read().count() == 3
