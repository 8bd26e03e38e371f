"""Versioned tables on plain parquet.

A table is a folder with ``rows/snap_v=P/snap_b=K`` (rows of the part P, written
by one attempt at a version, for hash bucket K of the key) and ``commits`` (one
small row per version, added after the data is complete). A commit names for
every live part the buckets it still provides, so a merge rewrites only the
buckets it changes, an append rewrites nothing, and older versions stay
readable. Every attempt writes a part of its own, so a failed or a late writer
leaves files that no commit names and never touches those of another one. An
object that does not know the newest version is refused before it writes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import hash_slot
from strata.functions.schemas import columns
from strata.operators.history import close_versions, open_versions, scd2_changes
from strata.operators.merge import change_feed, changes_by_version, unchanged_rows, unseen_versions, upsert_changes
from strata.operators.rows import widened

COMMIT_SCHEMA = columns(
    version="bigint",
    committed_at="timestamp",
    operation="string",
    inserted="bigint",
    updated="bigint",
    deleted="bigint",
    layout="string",
    row_schema="string",
    note="string",
)
VERSION, BUCKET = "snap_v", "snap_b"
DAY = 24 * 3600 * 1_000_000  # microseconds
Layout = dict[str, list[int]]


@dataclass(frozen=True)
class Staged:
    """Rows written for a version that is not committed yet."""

    version: int
    part: str
    schema: T.StructType


class SnapshotTable:
    """One table. An object sees the state of its first look plus its own commits;
    a new object looks again."""

    def __init__(
        self, spark: SparkSession, path: str, key: str, buckets: int = 1, identity: Sequence[str] | None = None
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.buckets = buckets
        self.identity = list(identity or [key])
        self._head: Row | None = None

    # -- commits ---------------------------------------------------------

    def commits(self) -> DataFrame:
        """One row per version, however many rows the table holds."""
        try:
            return (
                self.spark.read.schema(COMMIT_SCHEMA)
                .option("recursiveFileLookup", "true")
                .parquet(f"{self.path}/commits")
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMIT_SCHEMA)

    def _commit(self, version: int | None = None) -> Row | None:
        if version is not None:
            return self.commits().where(F.col("version") == version).first()
        if self._head is None:
            self._head = self.commits().orderBy(F.col("version").desc()).first()
        return self._head

    def version(self) -> int | None:
        latest = self._commit()
        return latest["version"] if latest else None

    def exists(self) -> bool:
        return self._commit() is not None

    def note(self) -> str | None:
        latest = self._commit()
        return latest["note"] if latest else None

    def _layout(self, commit: Row) -> Layout:
        """Buckets each live part provides; a part with all of them names none."""
        every = list(range(self.buckets))
        return {v: every if b is None else b for v, b in json.loads(commit["layout"]).items()}

    # -- reading ---------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        commit = self._required(version)
        return self._rows(commit, self._layout(commit))

    def _required(self, version: int | None) -> Row:
        commit = self._commit(version)
        if commit is None:
            raise ValueError(f"{self.path} has no version {version if version is not None else ''}")
        return commit

    def _rows(self, commit: Row, layout: Layout) -> DataFrame:
        """Rows of the named buckets; other buckets are pruned as partitions."""
        schema = T.StructType.fromJson(json.loads(commit["row_schema"]))
        if not layout:
            return self.spark.createDataFrame([], schema)
        names = schema.names
        physical = T.StructType(schema.fields).add(VERSION, T.StringType()).add(BUCKET, T.IntegerType())
        rows = (
            self.spark.read.schema(physical)
            .option("basePath", f"{self.path}/rows")
            .parquet(*[f"{self.path}/rows/{VERSION}={v}" for v in sorted(layout)])
        )
        wanted = F.lit(False)
        for v, buckets in sorted(layout.items()):
            part = F.col(VERSION) == v
            if len(buckets) < self.buckets:
                part = part & F.col(BUCKET).isin(buckets)
            wanted = wanted | part
        return rows.where(wanted).select(*names)

    # -- writing ---------------------------------------------------------

    def stage(self, rows: DataFrame, in_place: DataFrame | None = None) -> Staged:
        """Write rows for the next version without publishing them.

        ``rows`` are brought together per bucket. Rows in ``in_place`` come from
        this table's files and still lie bucket by bucket, so they are written
        where they are read, without a shuffle.
        """
        newest = self.commits().agg(F.max("version")).first()[0]
        if newest != self.version():
            raise RuntimeError(f"{self.path} is at version {newest}, this object knows {self.version()}")
        version = 0 if newest is None else newest + 1
        part = f"{version}-{uuid.uuid4().hex}"
        placed = self._bucketed(rows)
        # Adaptive execution sizes the files and splits a bucket that is too large.
        placed = placed.hint("rebalance", BUCKET) if self.buckets > 1 else placed
        if in_place is not None:
            placed = self._bucketed(in_place).unionByName(placed)
        placed.write.partitionBy(BUCKET).parquet(f"{self.path}/rows/{VERSION}={part}")
        return Staged(version, part, rows.schema)

    def staged_rows(self, staged: Staged) -> DataFrame:
        return (
            self.spark.read.schema(staged.schema)
            .parquet(f"{self.path}/rows/{VERSION}={staged.part}")
            .select(*staged.schema.names)
        )

    def publish(
        self,
        staged: Staged,
        operation: str,
        replaced: Iterable[int] | None = None,
        counts: Mapping[str, int] | None = None,
        note: str | None = None,
        at: datetime | None = None,
    ) -> int:
        """Commit staged rows; ``replaced`` buckets (all by default) leave older versions."""
        every = range(self.buckets)
        gone = set(every if replaced is None else replaced)
        previous = self._commit()
        layout: Layout = {}
        for v, buckets in (self._layout(previous) if previous else {}).items():
            left = [b for b in buckets if b not in gone]
            if left:
                layout[v] = left
        layout[staged.part] = sorted(gone) if gone else list(every)
        return self._record(staged.version, layout, staged.schema, operation, counts, note, at)

    def _record(
        self,
        version: int,
        layout: Layout,
        schema: T.StructType,
        operation: str,
        counts: Mapping[str, int] | None,
        note: str | None,
        at: datetime | None,
    ) -> int:
        counts = counts or {}
        values = {
            "version": version,
            "committed_at": at or datetime.now(UTC),
            "operation": operation,
            "inserted": counts.get("insert", 0),
            "updated": counts.get("update", 0),
            "deleted": counts.get("delete", 0),
            "layout": json.dumps({v: b if len(b) < self.buckets else None for v, b in layout.items()}),
            "row_schema": schema.json(),
            "note": self.note() if note is None else note,
        }
        row = self.spark.range(1).select(
            *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in COMMIT_SCHEMA]
        )
        row.write.mode("errorifexists").parquet(f"{self.path}/commits/{version:012d}")
        self._head = Row(**values)
        return version

    def overwrite(
        self, rows: DataFrame, note: str | None = None, at: datetime | None = None
    ) -> int:
        """Replace content and schema. The new rows may be computed from the old.

        A note says how far the table's input was taken in; a commit without one
        carries the last one on.
        """
        return self.publish(self.stage(rows), "overwrite", note=note, at=at)

    def append(self, rows: DataFrame, at: datetime | None = None) -> int:
        return self.publish(self.stage(rows), "append", replaced=[], at=at)

    # -- merges ----------------------------------------------------------

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, hash_slot([self.key], self.buckets).cast("int"))

    def _settle(
        self,
        changes: DataFrame,
        next_rows: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]],
        operation: str,
        note: str | None,
        at: datetime | None,
    ) -> dict[str, int]:
        """Rewrite the buckets that hold a change; no change, no version.

        ``next_rows`` turns current rows and changes into the rows that stay and
        the rows that come. The change set is computed once: its counts decide
        which buckets to rewrite. How it meets them is the planner's choice.
        """
        changes = changes.persist()
        try:
            per_bucket = self._bucketed(changes).groupBy(BUCKET, "_op").count().collect()
            counts: dict[str, int] = {}
            for row in per_bucket:
                counts[row["_op"]] = counts.get(row["_op"], 0) + row["count"]
            if counts:
                hit = {row[BUCKET] for row in per_bucket}
                commit = self._required(None)
                current = self._rows(commit, self._only(commit, hit))
                stay, come = next_rows(current, changes)
                self.publish(self.stage(stay.unionByName(come)), operation, hit, counts, note, at)
            return counts
        finally:
            changes.unpersist()

    def _only(self, commit: Row, hit: Iterable[int]) -> Layout:
        """The part of a commit's layout that lies in the given buckets."""
        wanted = set(hit)
        part = {v: [b for b in bs if b in wanted] for v, bs in self._layout(commit).items()}
        return {v: bs for v, bs in part.items() if bs}

    def touched_buckets(self, updates: DataFrame) -> DataFrame:
        """Current rows of the buckets that updates can reach."""
        commit = self._required(None)
        if self.buckets == 1:
            return self._rows(commit, self._layout(commit))
        hit = {r[BUCKET] for r in self._bucketed(updates).select(BUCKET).distinct().collect()}
        return self._rows(commit, self._only(commit, hit))

    def upsert(
        self, updates: DataFrame, note: str | None = None, at: datetime | None = None
    ) -> int:
        """Keyed upsert; returns rows inserted or updated, 0 on a replay.

        Updates must hold a key once; which of several rows counts is the caller's
        choice (``conform.newest_version``). A null key is a key like any other.
        Columns that only the updates have are added, null in all other rows.
        """
        self._refuse_repeated(updates)
        if not self.exists():
            return self._first_load(updates, note, at)
        changes = upsert_changes(self.touched_buckets(updates), updates, self.key)

        def after(rows: DataFrame, chg: DataFrame) -> tuple[DataFrame, DataFrame]:
            rows = widened(rows, updates)
            return unchanged_rows(rows, chg, self.key), chg.select(*rows.columns)

        return sum(self._settle(changes, after, "upsert", note, at).values())

    def _refuse_repeated(self, updates: DataFrame) -> None:
        repeated = updates.groupBy(self.key).count().where("count > 1").first()
        if repeated is not None:
            raise ValueError(f"several updates of {self.key} {repeated[0]}")

    def _first_load(self, rows: DataFrame, note: str | None, at: datetime | None) -> int:
        staged = self.stage(rows)
        size = self.staged_rows(staged).count()
        self.publish(staged, "load", counts={"insert": size}, note=note, at=at)
        return size

    def insert_versions(
        self, increment: DataFrame, moment: str, at: datetime | None = None
    ) -> tuple[int, datetime | None]:
        """Append unseen (key, ``moment``) combinations.

        Returns how many there were and their latest moment. Both come from the
        written rows, so a mark set from them never runs ahead of the table,
        even if the source gave different rows to a repeated task. Columns that
        only the increment has are added, null in all rows before.
        """
        if not self.exists():
            self.overwrite(increment.limit(0), at=at)
        names = widened(self.read().limit(0), increment).columns
        known = self.known_since(increment, moment)
        staged = self.stage(unseen_versions(known, increment, [self.key, moment]).select(*names))
        rows = self.staged_rows(staged)
        size, latest = rows.agg(F.count(F.lit(1)), F.max(moment)).first()
        if size:
            self.publish(staged, "insert", [], {"insert": size}, at=at)
        return size, latest

    def known_since(self, increment: DataFrame, moment: str) -> DataFrame:
        """Current rows that can repeat one of the increment: none is older than its oldest.

        The bound reaches the scan, so files of older rows are skipped by their
        statistics. A day of margin covers changes of the clock.
        """
        known = self.touched_buckets(increment)
        oldest = increment.agg(F.min(F.unix_micros(F.col(moment).cast("timestamp")))).first()[0]
        if oldest is None:
            return known
        bound = F.timestamp_micros(F.lit(oldest - DAY)).cast(known.schema[moment].dataType)
        return known.where(F.col(moment) >= bound)

    def rows_after(self, version: int) -> DataFrame:
        """Rows of parts written after a version; for tables that only append."""
        commit = self._required(None)
        return self._rows(commit, {p: b for p, b in self._layout(commit).items() if written_by(p) > version})

    def scd2(
        self,
        updates: DataFrame,
        tracked: list[str],
        effective: str = "modified_at",
        note: str | None = None,
        at: datetime | None = None,
    ) -> int:
        """Close changed versions and open new ones in one commit; returns new versions.

        Updates must hold a key once, as in ``upsert``; those not newer than the
        current version of their key change nothing.
        """
        self._refuse_repeated(updates)
        if not self.exists():
            return self._first_load(open_versions(updates, effective), note, at)
        changes = scd2_changes(
            self.touched_buckets(updates), updates, self.key, tracked, effective
        )

        def after(rows: DataFrame, chg: DataFrame) -> tuple[DataFrame, DataFrame]:
            rows = widened(rows, updates)
            opened = open_versions(chg.drop("_op"), effective).select(*rows.columns)
            return close_versions(rows, chg, self.key, effective), opened

        return sum(self._settle(changes, after, "scd2", note, at).values())

    # -- versions --------------------------------------------------------

    def _rewrite(
        self,
        condition: str,
        operation: str,
        next_rows: Callable[[DataFrame, Column], DataFrame],
        at: datetime | None,
    ) -> int:
        """Rewrite the buckets holding rows that satisfy the condition; returns those rows."""
        hit = F.coalesce(F.expr(condition), F.lit(False))
        commit = self._required(None)
        found = self._bucketed(self._rows(commit, self._layout(commit)).where(hit))
        sizes = {r[BUCKET]: r["count"] for r in found.groupBy(BUCKET).count().collect()}
        if sizes:
            current = self._rows(commit, self._only(commit, sizes))
            counts = {operation: sum(sizes.values())}
            staged = self.stage(current.limit(0), in_place=next_rows(current, hit))
            self.publish(staged, operation, sizes, counts, at=at)
        return sum(sizes.values())

    def update_where(
        self, condition: str, assignments: Mapping[str, str], at: datetime | None = None
    ) -> int:
        """Assign expressions in rows that satisfy the condition; the key stays as it is."""
        if self.key.lower() in {c.lower() for c in assignments}:
            raise ValueError(f"{self.key} decides where a row lies and can't be assigned")

        def assigned(rows: DataFrame, hit: Column) -> DataFrame:
            return rows.withColumns(
                {
                    c: F.when(hit, F.expr(e).cast(rows.schema[c].dataType)).otherwise(F.col(c))
                    for c, e in assignments.items()
                }
            )

        return self._rewrite(condition, "update", assigned, at)

    def delete_where(self, condition: str, at: datetime | None = None) -> int:
        """Drop rows that satisfy the condition; undecided (NULL) rows stay."""
        return self._rewrite(condition, "delete", lambda rows, hit: rows.where(~hit), at)

    def compact(self, at: datetime | None = None) -> int:
        """Rewrite all live parts into one version with well-sized files."""
        return self.publish(self.stage(self.read()), "compact", at=at)

    def restore(self, version: int, at: datetime | None = None) -> int:
        """Make an older version the newest. Its files are named again, not copied."""
        old = self._required(version)
        latest = self._required(None)["version"]
        schema = T.StructType.fromJson(json.loads(old["row_schema"]))
        return self._record(latest + 1, self._layout(old), schema, "restore", None, None, at)

    def changes_between(self, older: int, newer: int) -> DataFrame:
        """Change feed of two versions; parts both versions share are not read.

        Rows are matched by the table's identity, the key unless it was given.
        """
        a, b = self._required(older), self._required(newer)
        left, right = self._layout(a), self._layout(b)
        before = self._rows(a, _minus(left, right))
        after = self._rows(b, _minus(right, left))
        return change_feed(before, after, self.identity).withColumn(
            "_commit_version", F.lit(newer).cast("bigint")
        )


    def changes(self, since: int = 0, until: int | None = None) -> DataFrame:
        """Change feed of every commit from ``since`` to ``until``, with version and time.

        One pass over the rows that came or went: a bucket of a part holds from
        the commit that names it to the one that drops it, and every such piece is
        read once, however many versions have it. Pieces that hold all along are
        not read. Columns that were added later are null in older rows.
        """
        commits = self.commits().where(F.col("version").between(since - 1, 2**62 if until is None else until))
        history = commits.orderBy("version").collect()  # one small row per version
        held: dict[tuple[str, int], list[list[int | None]]] = {}
        for commit in history:
            live = {(part, bucket) for part, buckets in self._layout(commit).items() for bucket in buckets}
            for piece in live:
                spans = held.setdefault(piece, [])
                if not spans or spans[-1][1] is not None:
                    spans.append([commit["version"], None])
            for piece, spans in held.items():
                if piece not in live and spans[-1][1] is None:
                    spans[-1][1] = commit["version"]
        moved = [(part, bucket, *span) for (part, bucket), spans in held.items() for span in spans if span[0] >= since or span[1] is not None]
        fields = {f.name: f for commit in history for f in T.StructType.fromJson(json.loads(commit["row_schema"]))}
        physical = T.StructType(list(fields.values())).add(VERSION, T.StringType()).add(BUCKET, T.IntegerType())
        spans = self.spark.createDataFrame(moved, f"{VERSION} string, {BUCKET} int, _from bigint, _until bigint")
        parts = sorted({part for part, *_ in moved})
        if not parts:
            rows = self.spark.createDataFrame([], physical)
        else:
            rows = self.spark.read.schema(physical).option("basePath", f"{self.path}/rows").parquet(*[f"{self.path}/rows/{VERSION}={part}" for part in parts])
        images = rows.join(spans, [VERSION, BUCKET]).drop(VERSION, BUCKET)
        times = commits.select(F.col("version").alias("_commit_version"), F.col("committed_at").alias("_commit_timestamp"))
        return changes_by_version(images, self.identity, since).join(times, "_commit_version")


def written_by(part: str) -> int:
    """Version a part was written for."""
    return int(part.partition("-")[0])


def _minus(left: Layout, right: Layout) -> Layout:
    rest = {v: [b for b in bs if b not in right.get(v, [])] for v, bs in left.items()}
    return {v: bs for v, bs in rest.items() if bs}


def retention_candidates(commits: DataFrame, as_of: datetime, keep_hours: int = 168) -> DataFrame:
    """Versions replaced more than ``keep_hours`` ago whose rows no kept version uses (a dry run)."""
    following = commits.select(
        (F.col("version") - 1).alias("version"), F.col("committed_at").alias("replaced_at")
    )
    limit = F.lit(as_of - timedelta(hours=keep_hours))
    dated = commits.join(following, "version", "left")
    kept = dated.where(F.col("replaced_at").isNull() | (F.col("replaced_at") >= limit))
    parts = kept.select(F.explode(F.json_object_keys("layout")).alias("part"))
    used = parts.select(F.substring_index("part", "-", 1).cast("bigint").alias("version")).distinct()
    old = dated.where(F.col("replaced_at") < limit).join(used, "version", "left_anti")
    return old.select("version", "operation", "replaced_at")
