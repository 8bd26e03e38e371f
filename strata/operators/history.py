"""Slowly changing history: first load, batch by batch, and in one go.

History columns are ``valid_from``, ``valid_to`` and ``is_current``; validity
is half-open and a key has one current row. All functions are pure: they return
the rows of the next state or the change set that leads to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import differs
from strata.functions.skew import found_hot_keys, neighbour
from strata.functions.windows import first_by
from strata.operators.rows import matched, touched_rows, widened


def open_versions(rows: DataFrame, effective: str = "modified_at") -> DataFrame:
    """Rows as current versions that start at their effective time."""
    start = F.col(effective)
    return rows.select(
        "*",
        start.alias("valid_from"),
        F.lit(None).cast(rows.schema[effective].dataType).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_changes(
    history: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective: str = "modified_at",
) -> DataFrame:
    """Updates that start a new version: new keys and keys with a tracked change.

    ``updates`` has one row per key, null being a key like any other. ``_op``
    tells ``insert`` from ``update``. An update that is not newer than the
    version it would close changes nothing, as no interval may end before it
    begins. The current versions are first cut down to the keys of the update, which
    needs no shuffle of the history while the update is small.
    """
    current = touched_rows(widened(history, updates).where("is_current"), updates, [key])
    before = current.select(
        F.col(key),
        *[F.col(c).alias(f"_old_{c}") for c in tracked],
        F.col("valid_from").alias("_since"),
        F.lit(1).alias("_hit"),
    )
    changed = differs([F.col(c) for c in tracked], [F.col(f"_old_{c}") for c in tracked])
    newer = F.col("_since").isNull() | (F.col(effective) > F.col("_since"))
    return (
        matched(updates, before, [key], "left")
        .where(F.col("_hit").isNull() | (changed & newer))
        .select(
            *[F.col(c) for c in updates.columns],
            F.when(F.col("_hit").isNull(), "insert").otherwise("update").alias("_op"),
        )
    )


def close_versions(
    history: DataFrame, changes: DataFrame, key: str, effective: str = "modified_at"
) -> DataFrame:
    """History with the current version of every changed key closed."""
    closing = changes.where("_op = 'update'").select(key, F.col(effective).alias("_closed_at"))
    ends = F.col("is_current") & F.col("_closed_at").isNotNull()
    return (
        matched(history, closing, [key], "left")
        .withColumns(
            {
                "valid_to": F.when(ends, F.col("_closed_at")).otherwise(F.col("valid_to")),
                "is_current": F.when(ends, F.lit(False)).otherwise(F.col("is_current")),
            }
        )
        .select(*history.columns)
    )


def scd2_state(
    history: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective: str = "modified_at",
) -> DataFrame:
    """Complete next history after one batch of updates."""
    changes = scd2_changes(history, updates, key, tracked, effective)
    opened = open_versions(changes.drop("_op"), effective)
    history = widened(history, updates)
    closed = close_versions(history, changes, key, effective)
    return closed.unionByName(opened.select(*history.columns))


def full_history(
    versions: DataFrame,
    key: str,
    at: str,
    tracked: Sequence[str],
    tie_break: Sequence[str] = (),
    hot: DataFrame | None = None,
) -> DataFrame:
    """The history that version-by-version batches would build, in one pass.

    Several versions of a key at one instant count as the one that is last by
    ``tie_break``. Rows that change no tracked column start no version.

    Without hot keys everything happens in one shuffle by key. Keys in ``hot``
    (looked up here unless given) are processed in daily pieces.
    """
    hot = found_hot_keys(versions, [key]) if hot is None else hot
    placed = versions if hot is not None else versions.repartition(key)
    points = first_by(placed, [key, at], [F.col(c).desc() for c in tie_break or tracked])
    points = points.select(key, at, *tracked)
    state = F.struct(*tracked)
    seen = neighbour(points, key, at, state, "_before", ahead=False, hot=hot)
    starts = seen.where(F.col("_before").isNull() | ~state.eqNullSafe(F.col("_before")))
    starts = starts.drop("_before").withColumnRenamed(at, "valid_from")
    spans = neighbour(starts, key, "valid_from", F.col("valid_from"), "valid_to", True, hot=hot)
    return spans.withColumn("is_current", F.col("valid_to").isNull())


def earliest_and_daily(history: DataFrame, key: str, carried: Sequence[str]) -> DataFrame:
    """Versions reduced to what a whole day can see.

    Among versions of a key that begin before the same midnight only the last
    one reaches it, so one row per key and day is kept: ``_version`` with that
    version and ``_first`` with the earliest of the group. Empty intervals are
    valid at no time and only matter as earliest version.
    """
    clock = history.schema["valid_from"].dataType
    at_midnight = F.col("valid_from") == F.to_date("valid_from").cast(clock)
    midnight = F.date_add(F.to_date("valid_from"), F.when(at_midnight, 0).otherwise(1))
    alive = F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to"))
    body = F.struct("valid_from", "valid_to", *carried)
    return (
        history.withColumn("_day", midnight)
        .groupBy(key, "_day")
        .agg(
            F.max_by(F.when(alive, body), F.when(alive, F.col("valid_from"))).alias("_version"),
            F.min_by(body, F.col("valid_from")).alias("_first"),
        )
    )
