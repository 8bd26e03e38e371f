"""Run records, freshness and other operational reports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import UTC, date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import moment, trailing_days
from strata.functions.schemas import columns
from strata.functions.windows import first_by

RUN_SCHEMA = columns(
    run_id="string",
    task="string",
    status="string",
    started_at="timestamp",
    finished_at="timestamp",
    metrics="texts",
    message="string",
)
NEVER = 999


class AppendLog:
    """Append-only parquet table with a declared schema."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def read(self) -> DataFrame:
        """All rows; none while nothing was written yet."""
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def add(self, values: Mapping[str, object]) -> None:
        def column(field: T.StructField):
            value = values.get(field.name)
            if isinstance(value, Mapping):
                pairs = [F.lit(str(x)) for pair in value.items() for x in pair]
                value = F.create_map(*pairs) if pairs else F.create_map()
            else:
                value = F.lit(value)
            return value.cast(field.dataType).alias(field.name)

        row = self.spark.range(1).select(*[column(f) for f in self.schema])
        row.write.mode("append").parquet(self.path)


def log_run(
    log: AppendLog,
    task: str,
    status: str,
    started_at: datetime,
    metrics: Mapping[str, object] | None = None,
    message: str | None = None,
) -> str:
    """Append one run; metric values are kept as text. Returns the run id."""
    run_id = str(uuid.uuid4())
    log.add(
        {
            "run_id": run_id,
            "task": task,
            "status": status,
            "started_at": started_at,
            "finished_at": datetime.now(UTC),
            "metrics": dict(metrics or {}),
            "message": message,
        }
    )
    return run_id


def _hours(since: str, as_of: datetime) -> Column:
    return F.timestamp_diff("HOUR", F.col(since), moment(as_of, T.TimestampNTZType()))


def layer_freshness(layers: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Newest moment per layer, from the given column of the given table."""
    out = None
    for layer, (rows, column) in layers.items():
        one = rows.agg(F.max(column).cast("timestamp_ntz").alias("freshness")).select(
            F.lit(layer).alias("layer"), "freshness"
        )
        out = one if out is None else out.unionByName(one)
    return out


def task_freshness(runs: DataFrame, as_of: datetime) -> DataFrame:
    done = runs.where("status = 'succeeded'").groupBy("task")
    latest = done.agg(F.max("finished_at").alias("last_success"))
    return latest.withColumn("hours_since", _hours("last_success", as_of)).orderBy(
        F.col("hours_since").desc(), "task"
    )


def rows_per_run(runs: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Rows a run processed: rows changed where reported, else rows read."""
    shown = F.coalesce(
        F.try_element_at("metrics", F.lit("rows_changed")),
        F.try_element_at("metrics", F.lit("rows")),
    )
    return (
        runs.where(F.col("status") == "succeeded")
        .where(trailing_days("started_at", as_of, days))
        .where(shown.isNotNull())
        .select("started_at", "task", shown.try_cast("bigint").alias("rows_processed"))
        .orderBy("started_at")
    )


def failure_log(runs: DataFrame, limit: int = 50) -> DataFrame:
    failed = runs.where("status <> 'succeeded'")
    newest = failed.orderBy(F.col("started_at").desc(), "run_id").limit(limit)
    return newest.select("started_at", "task", "status", "message")


def _named_runs(timeline: DataFrame, jobs: DataFrame, as_of: date, days: int) -> DataFrame:
    """Finished runs of the last days with the newest name of their job."""
    newest = [F.col("change_time").desc(), F.col("seq").desc()]
    names = first_by(jobs, ["job_id"], newest).select("job_id", F.col("name").alias("job_name"))
    seconds = F.timestamp_diff("SECOND", F.col("period_start_time"), F.col("period_end_time"))
    recent = timeline.where(
        F.col("result_state").isNotNull() & trailing_days("period_start_time", as_of, days)
    )
    return recent.join(names, "job_id").withColumn("_seconds", seconds)


def job_run_history(
    timeline: DataFrame, jobs: DataFrame, as_of: date, days: int = 30
) -> DataFrame:
    named = _named_runs(timeline, jobs, as_of, days)
    return named.select(
        "run_id",
        "job_name",
        "result_state",
        "trigger_type",
        "period_start_time",
        "period_end_time",
        (F.col("_seconds").cast("double") / 60).alias("duration_min"),
    ).orderBy(F.col("period_start_time").desc(), "run_id")


def duration_trend(timeline: DataFrame, jobs: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    named = _named_runs(timeline, jobs, as_of, days)
    return (
        named.groupBy(F.to_date("period_start_time").alias("run_date"), "job_name")
        .agg((F.avg("_seconds") / 60).alias("avg_duration_min"))
        .orderBy("run_date", "job_name")
    )


def staleness(runs: DataFrame, task: str, as_of: datetime, alert_after: int = 24) -> DataFrame:
    """Hours since a task last succeeded, a fixed high value if it never did."""
    done = runs.where((F.col("task") == task) & (F.col("status") == "succeeded"))
    hours = F.coalesce(_hours("_last", as_of), F.lit(NEVER).cast("bigint"))
    return (
        done.agg(F.max("finished_at").cast("timestamp_ntz").alias("_last"))
        .select(F.lit(task).alias("task"), hours.alias("hours_since_refresh"))
        .withColumn("alert", F.col("hours_since_refresh") > alert_after)
    )
