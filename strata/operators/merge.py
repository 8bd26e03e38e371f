"""Merges as pure plans: what changes, the state after it, and the change feed.

The target of a merge is large and the update usually small, so every merge
first cuts the target down to the keys of the update with a semi join. Spark
broadcasts the key side while it is small (its size is measured at run time)
and falls back to a shuffle beyond that; either way no later step sees target
rows the update does not touch.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import differs, moment
from strata.functions.windows import first_by
from strata.operators.rows import business_columns, matched, touched_rows, widened

# Mark of a source that was never read.
NEVER_READ = datetime(1900, 1, 1)


def unseen_versions(target: DataFrame, increment: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the increment whose key combination the target does not hold yet.

    A combination repeated inside the increment counts once.
    """
    rest = [c for c in increment.columns if c not in keys]
    single = first_by(increment, keys, [F.col(c).desc() for c in rest])
    known = touched_rows(target, increment, keys).select(*keys)
    return matched(single, known, keys, "left_anti")


def upsert_changes(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates that insert a key or change a business column, with ``_op``.

    A null key is a key like any other. A column that only the updates have was
    null before.
    """
    target, business = widened(target, updates), business_columns(updates, key)
    before = touched_rows(target, updates, [key]).select(
        F.col(key), *[F.col(c).alias(f"_old_{c}") for c in business], F.lit(1).alias("_hit")
    )
    changed = differs([F.col(c) for c in business], [F.col(f"_old_{c}") for c in business])
    op = F.when(F.col("_hit").isNull(), "insert").when(changed, "update")
    return (
        matched(updates, before, [key], "left")
        .select(*[F.col(c) for c in updates.columns], op.alias("_op"))
        .where("_op is not null")
    )


def unchanged_rows(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    return matched(target, changes.select(key), [key], "left_anti")


def with_changes(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target with changed rows replaced and new ones added."""
    target = widened(target, changes.drop("_op"))
    kept = unchanged_rows(target, changes, key)
    return kept.unionByName(changes.select(*target.columns))


def upsert_state(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    return with_changes(target, upsert_changes(target, updates, key), key)


def count_ops(changes: DataFrame) -> DataFrame:
    """Inserted, updated and changed rows of a change set, as one row."""
    return changes.agg(
        F.count_if(F.col("_op") == "insert").alias("inserted"),
        F.count_if(F.col("_op") == "update").alias("updated"),
        F.count(F.lit(1)).alias("rows_changed"),
    )


def state_pairs(
    before: DataFrame, after: DataFrame, identity: str | Sequence[str], placed: bool = False
) -> DataFrame:
    """All rows of two states of a table, matched by identity: ``_pre`` and ``_post``, null where there is none.

    ``identity`` names the columns that tell rows apart, nulls included. Columns
    that only one state has are null in the rows of the other.

    States that are ``placed`` are partitioned by the identity already. Their rows
    are joined by plain equality, which takes them as they lie, where a null-safe
    join shuffles both again; those with a null in their identity are joined apart.
    """
    keys = [identity] if isinstance(identity, str) else list(identity)
    kinds = {f.name: f.dataType for f in (*before.schema, *after.schema)}
    names = [*before.columns, *[c for c in after.columns if c not in before.columns]]

    def row(state: DataFrame, alias: str) -> DataFrame:
        cells = [(F.col(c) if c in state.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in names]
        return state.select(*[F.col(k).alias(f"{alias}_{i}") for i, k in enumerate(keys)], F.struct(*cells).alias(alias))

    old, new = row(before, "_pre"), row(after, "_post")
    same, equal, old_named, new_named = (F.lit(True) for _ in range(4))
    for i in range(len(keys)):
        pre, post = F.col(f"_pre_{i}"), F.col(f"_post_{i}")
        same, equal = same & pre.eqNullSafe(post), equal & (pre == post)
        old_named, new_named = old_named & pre.isNotNull(), new_named & post.isNotNull()
    if placed:
        whole = old.where(old_named).join(new.where(new_named), equal, "full")
        pairs = whole.unionByName(old.where(~old_named).join(new.where(~new_named), same, "full"))
    else:
        pairs = old.join(new, same, "full")
    return pairs.select("_pre", "_post")


def pair_changes(pairs: DataFrame) -> DataFrame:
    """Row changes between the two states of ``state_pairs``, with images before and after."""

    def image(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(side).alias("_row"))

    images = (
        F.when(F.col("_pre").isNull(), F.array(image("insert", "_post")))
        .when(F.col("_post").isNull(), F.array(image("delete", "_pre")))
        .otherwise(F.array(image("update_preimage", "_pre"), image("update_postimage", "_post")))
    )
    return (
        pairs.where(~F.col("_pre").eqNullSafe(F.col("_post")))
        .select(F.explode(images).alias("_change"))
        .select("_change._change_type", "_change._row.*")
    )


def change_feed(
    before: DataFrame, after: DataFrame, identity: str | Sequence[str], placed: bool = False
) -> DataFrame:
    """Row changes between two states of a table, with images before and after; see ``state_pairs``."""
    return pair_changes(state_pairs(before, after, identity, placed))


def changes_by_version(images: DataFrame, identity: Sequence[str], since: int) -> DataFrame:
    """Row changes of every version from ``since`` on, with ``_commit_version``.

    ``images`` has each state of a row once, with the version ``_from`` which it
    holds and the version ``_until`` where it no longer does (null: still). What
    holds before ``since`` is where the changes start from. Images of a row are
    held against the one before and the one after it, in one window by
    ``identity``, nulls included: two that touch and differ are an update, two
    that are equal no change, a gap is a delete and an insert.
    """
    names = [c for c in images.columns if c not in ("_from", "_until")]
    rows = images.select(*[F.col(c).alias(f"_id_{i}") for i, c in enumerate(identity)], F.struct(*names).alias("_row"), "_from", "_until")
    one = Window.partitionBy(*[f"_id_{i}" for i in range(len(identity))]).orderBy("_from")
    seen = rows.withColumns(
        {"_before": F.lag(F.struct("_row", "_until")).over(one), "_after": F.lead("_from").over(one)}
    )
    follows = F.coalesce(F.col("_before._until") == F.col("_from"), F.lit(False))

    def image(kind: str, version: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(version).cast("bigint").alias("_commit_version"), F.col(row).alias("_row"))

    begins = (
        F.when(F.col("_from") < since, F.array())
        .when(~follows, F.array(image("insert", "_from", "_row")))
        .when(F.col("_row").eqNullSafe(F.col("_before._row")), F.array())
        .otherwise(F.array(image("update_preimage", "_from", "_before._row"), image("update_postimage", "_from", "_row")))
    )
    gone = (F.col("_until") >= since) & ~F.coalesce(F.col("_after") == F.col("_until"), F.lit(False))
    ends = F.when(gone, F.array(image("delete", "_until", "_row"))).otherwise(F.array())
    return (
        seen.select(F.explode(F.concat(begins, ends)).alias("_change"))
        .select("_change._change_type", "_change._commit_version", "_change._row.*")
    )


def recent_changes(feed: DataFrame, key: str, limit: int = 100) -> DataFrame:
    """Newest commits first; a top-k, so no full sort takes place."""
    return feed.orderBy(F.col("_commit_version").desc(), key, "_change_type").limit(limit)


def marks_for(sources: DataFrame, marks: DataFrame) -> DataFrame:
    """High-water mark of each requested source, the default where none is set."""
    kind = marks.schema["watermark"].dataType
    known = marks.groupBy("source").agg(F.max("watermark").alias("watermark"))
    return sources.join(known, "source", "left").withColumn(
        "watermark", F.coalesce("watermark", moment(NEVER_READ, kind))
    )


def advanced_marks(marks: DataFrame, increment: DataFrame, moved_at: Column) -> DataFrame:
    """Marks after an increment (``source``, ``modified_at``); one row per source.

    A source without new rows keeps its mark.
    """
    reached = increment.groupBy("source").agg(F.max("modified_at").alias("watermark"))
    update = reached.where("watermark is not null").withColumn(
        "updated_at", moved_at.cast(marks.schema["updated_at"].dataType)
    )
    return upsert_state(marks, update, "source")
