from datetime import datetime

import pytest

from strata.operators import benchmarks, gates, runs
from strata.plans.lake import Lake, check
from tests.conftest import sets


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (2, "c")], "id int, name string")


def verdicts(frame):
    return [(r["gate"], r["passed"], r["observed"]) for r in frame.collect()]


def test_gates(rows):
    checks = [gates.at_least(3), gates.at_least(4), gates.unique("id")]
    checks += [gates.mostly_set("name", 0.5), gates.mostly_set("name", 0.1)]
    assert set(verdicts(gates.check_table(rows, "t", checks))) == {
        ("row_count_min", True, "3"),
        ("row_count_min", False, "3"),
        ("pk_unique", False, "1 duplicate keys"),
        ("null_ratio_max", True, "0.3333"),
        ("null_ratio_max", False, "0.3333"),
    }


def test_gates_on_no_rows_and_null_keys(spark, rows):
    none = gates.check_table(rows.limit(0), "t", [gates.unique("id"), gates.mostly_set("name", 0.0)])
    assert verdicts(none) == [("pk_unique", True, "0 duplicate keys"), ("null_ratio_max", True, "0.0000")]
    nulls = spark.createDataFrame([(None,), (None,), (1,)], "id int")
    assert verdicts(gates.check_table(nulls, "t", [gates.unique("id")])) == [
        ("pk_unique", False, "1 duplicate keys")
    ]


def test_failed_gate_is_logged_then_raised(spark, rows, folder):
    lake = Lake(spark, folder)
    report = gates.check_table(rows, "t", [gates.at_least(1), gates.at_least(9)])
    with pytest.raises(gates.GateFailure, match="row_count_min"):
        check(lake, report)
    logged = lake.runs.read().collect()
    assert [(r["task"], r["status"], r["message"]) for r in logged] == [
        ("quality_gates", "failed", "1 of 2 gates failed")
    ]


def test_run_log_keeps_metrics_as_text(spark, folder):
    log = runs.AppendLog(spark, f"{folder}/runs", runs.RUN_SCHEMA)
    assert log.read().count() == 0
    runs.log_run(log, "silver", "succeeded", datetime(2026, 6, 1), {"rows": 42})
    runs.log_run(log, "silver", "failed", datetime(2026, 6, 2), message="x")
    got = log.read().orderBy("started_at").collect()
    assert got[0]["metrics"] == {"rows": "42"} and got[1]["metrics"] == {}
    assert got[0]["run_id"] != got[1]["run_id"] and got[0]["started_at"] == datetime(2026, 6, 1)


def test_staleness_of_a_task_that_never_ran(spark):
    none = spark.createDataFrame([], "task string, status string, finished_at timestamp")
    row = runs.staleness(none, "gold", datetime(2026, 6, 1)).first()
    assert (row["hours_since_refresh"], row["alert"]) == (999, True)


def brute_median(values):
    rest = sorted(values[1:] or values)
    n = len(rest)
    return int((rest[(n - 1) // 2] + rest[n // 2]) / 2)


def test_warm_median_matches_brute_force(spark):
    import random

    rng = random.Random(3)
    cases = {f"q{i}": [rng.choice([5, 9, 5000, rng.randrange(40_000)]) for _ in range(i + 1)] for i in range(12)}
    made = [(n, i, f"{i:03d}", v) for n, vs in cases.items() for i, v in enumerate(vs)]
    frame = spark.createDataFrame(made, "name string, ts long, bench_id string, duration_ms long")
    got = {r["name"]: r["warm_median_ms"] for r in benchmarks.warm_median(frame).collect()}
    assert got == {n: brute_median(vs) for n, vs in cases.items()}


def test_benchmark_rows(spark, folder):
    log = runs.AppendLog(spark, f"{folder}/bench", benchmarks.BENCHMARK_SCHEMA)
    benchmarks.record(log, "layout", "q__a", 12, {"query": "q", "variant": "a"}, {"rows_out": 50})
    benchmarks.record(log, "layout", "q__a", 10, {"query": "q", "variant": "a"})
    benchmarks.record(log, "query", "x", 1, {"case": "c", "phase": "bad"})
    assert sets(benchmarks.best_layouts(log.read()), "query", "variant", "duration_ms") == {("q", "a", 10)}
    assert log.read().where("duration_ms = 12").first()["metrics"] == {"rows_out": "50"}
    text = [r["benchmark"] for r in benchmarks.as_json_lines(log.read()).collect()]
    assert len(text) == 3 and '"category":"layout"' in text[0]
    benchmarks.export_json(log.read(), f"{folder}/json")
    assert [r["value"] for r in spark.read.text(f"{folder}/json").collect()] == text
