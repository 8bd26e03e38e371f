import random

from strata.functions.skew import hot_keys
from strata.operators import history
from tests.conftest import at, sets

SCHEMA = "customer_id int, city string, region string, modified_at timestamp"
TRACKED = ["city", "region"]


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def test_first_load_is_current(spark):
    out = history.open_versions(rows(spark, (1, "A", "w", at(1)))).first()
    assert (out["valid_from"], out["valid_to"], out["is_current"]) == (at(1), None, True)


def test_change_closes_and_opens(spark):
    first = history.open_versions(rows(spark, (1, "A", "w", at(1))))
    after = history.scd2_state(first, rows(spark, (1, "B", "w", at(5))), "customer_id", TRACKED)
    assert sets(after, "city", "valid_from", "valid_to", "is_current") == {
        ("A", at(1), at(5), False),
        ("B", at(5), None, True),
    }


def test_newer_time_alone_is_no_change(spark):
    first = history.open_versions(rows(spark, (1, "A", None, at(1))))
    after = history.scd2_state(first, rows(spark, (1, "A", None, at(9))), "customer_id", TRACKED)
    assert after.count() == 1


def test_change_to_and_from_null_counts(spark):
    first = history.open_versions(rows(spark, (1, "A", "w", at(1)), (2, "A", None, at(1))))
    batch = rows(spark, (1, "A", None, at(2)), (2, "A", "w", at(2)))
    after = history.scd2_state(first, batch, "customer_id", TRACKED)
    assert after.count() == 4 and after.where("is_current").count() == 2


def test_mixed_batch_and_replay(spark):
    first = history.open_versions(rows(spark, (1, "A", "w", at(1)), (2, "A", "w", at(1))))
    batch = rows(spark, (1, "B", "w", at(2)), (3, "C", "w", at(2)))
    once = history.scd2_state(first, batch, "customer_id", TRACKED)
    assert once.count() == 4
    assert history.scd2_changes(once, batch, "customer_id", TRACKED).count() == 0
    twice = history.scd2_state(once, batch, "customer_id", TRACKED)
    columns = once.columns
    assert sets(once, *columns) == sets(twice, *columns)


def random_versions(spark, seed=7, keys=12, moments=60):
    rng = random.Random(seed)
    made = [
        (k, rng.choice("ABC"), rng.choice(["w", None]), at(1 + m // 24, m % 24))
        for k in range(keys)
        for m in sorted(rng.sample(range(moments), 30 if k else moments))
    ]
    return made, spark.createDataFrame(made, SCHEMA)


def test_batches_one_version_at_a_time_build_the_full_history(spark):
    made = [
        (k, "AB"[(k + m // 2) % 2], None if m % 3 else "w", at(1 + m))
        for k in range(3)
        for m in range(5)
    ]
    frame = spark.createDataFrame(made, SCHEMA)
    state = None
    for m in range(5):
        batch = spark.createDataFrame([r for r in made if r[3] == at(1 + m)], SCHEMA)
        if state is None:
            state = history.open_versions(batch)
        else:
            state = history.scd2_state(state, batch, "customer_id", TRACKED)
        state = spark.createDataFrame(state.collect(), state.schema)
    full = history.full_history(frame, "customer_id", "modified_at", TRACKED)
    names = ["customer_id", "city", "region", "valid_from", "valid_to", "is_current"]
    assert sets(state, *names) == sets(full, *names)


def brute_force(made):
    out = set()
    for key in {r[0] for r in made}:
        mine = sorted((r for r in made if r[0] == key), key=lambda r: r[3])
        kept = [r for i, r in enumerate(mine) if i == 0 or mine[i - 1][1:3] != r[1:3]]
        for i, r in enumerate(kept):
            end = kept[i + 1][3] if i + 1 < len(kept) else None
            out.add((key, r[1], r[2], r[3], end))
    return out


def test_hot_keys_are_cut_into_pieces_without_changing_the_result(spark):
    made, frame = random_versions(spark)
    names = ["customer_id", "city", "region", "valid_from", "valid_to"]
    hot = hot_keys(frame, ["customer_id"], share=0.1, floor=5)
    assert sets(hot, "customer_id") == {(0,)}
    cut = history.full_history(frame, "customer_id", "modified_at", TRACKED, hot=hot)
    plain = history.full_history(frame, "customer_id", "modified_at", TRACKED)
    assert sets(cut, *names) == sets(plain, *names) == brute_force(made)


def test_every_key_hot_gives_the_same(spark):
    made, frame = random_versions(spark, seed=11)
    hot = hot_keys(frame, ["customer_id"], share=0.0, floor=0)
    names = ["customer_id", "city", "region", "valid_from", "valid_to"]
    cut = history.full_history(frame, "customer_id", "modified_at", TRACKED, hot=hot)
    assert sets(cut, *names) == brute_force(made)
