"""Aggregates that follow change feeds.

A change is a row with a weight: how often it comes (above zero) or goes (below).
Joins and sums are linear in weights, so what a change does to an aggregate is
the same aggregate over the changed rows, multiplied by their weights. A table
of sums keeps the number of rows of each group, and of values of each sum,
beside the sums, so that a group goes when its last row does and a sum of nothing
is null. Distinct counts come from a finer table of sums, whose groups appear
and vanish.

Only groups and keys that a change touches are looked up in a state; the work
grows with the change, apart from reading.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.rows import matched

WEIGHT = "_weight"
ROWS = "n_rows"
Value = Callable[[], Column]


def signed(feed: DataFrame) -> DataFrame:
    """Rows of a change feed with their weight."""
    comes = F.col("_change_type").isin("insert", "update_postimage")
    marks = [c for c in feed.columns if c.startswith("_c")]
    return feed.withColumn(WEIGHT, F.when(comes, 1).otherwise(-1).cast("bigint")).drop(*marks)


def stated(rows: DataFrame) -> DataFrame:
    """All rows of a table, each coming once."""
    return rows.withColumn(WEIGHT, F.lit(1).cast("bigint"))


def joined(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Join of weighted rows; weights multiply."""
    other = right.withColumnRenamed(WEIGHT, "_other")
    both = left.join(other, on)
    return both.withColumn(WEIGHT, F.col(WEIGHT) * F.col("_other")).drop("_other")


def joined_change(
    old_left: DataFrame, left: DataFrame, new_right: DataFrame, right: DataFrame, on: str
) -> DataFrame:
    """What changes of both sides do to their join, from the old left and the new right state.

    ``left`` and ``right`` are the weighted changes. Each state is cut down to
    the keys of the other side's changes first.
    """
    near = matched(new_right, left.select(on), [on], "left_semi")
    far = matched(old_left, right.select(on), [on], "left_semi")
    return joined(left, stated(near), on).unionByName(joined(stated(far), right, on))


class Sums:
    """A table of sums by group: columns ``by``, ``n_rows``, and for each sum itself and ``<sum>_n``.

    ``sums`` maps a name to a function that gives an expression over the rows, and
    to the type of its sum.
    """

    def __init__(self, by: Sequence[str], sums: Mapping[str, tuple[Value, str]]):
        self.by = list(by)
        self.sums = dict(sums)
        self.figures = [ROWS, *[c for name in self.sums for c in (name, f"{name}_n")]]

    def of(self, rows: DataFrame) -> DataFrame:
        """Sums of weighted rows; groups of which all figures are zero are left out."""
        weight = F.col(WEIGHT)
        figures = [F.sum(weight).alias(ROWS)]
        for name, (of, kind) in self.sums.items():
            value = of()
            figures.append(F.coalesce(F.sum(value * weight), F.lit(0)).cast(kind).alias(name))
            figures.append(F.sum(F.when(value.isNotNull(), weight).otherwise(0)).alias(f"{name}_n"))
        return self._nonzero(rows.groupBy(*self.by).agg(*figures))

    def _nonzero(self, sums: DataFrame) -> DataFrame:
        some = F.lit(False)
        for c in self.figures:
            some = some | (F.col(c) != 0)
        return sums.where(some)

    def changes(self, state: DataFrame, change: DataFrame, cut: bool = True) -> DataFrame:
        """What summed changes do to a state: touched groups with new figures, old ones (``_was_``) and ``_op``.

        The state is ``cut`` down to the groups of the change first, which Spark
        broadcasts while they are few. Of a change as large as the state that only
        works out the change twice and shuffles its groups once more.
        """
        old = state.select(*self.by, *[F.col(c).alias(f"_was_{c}") for c in self.figures])
        if cut:
            old = matched(old, change.select(*self.by), self.by, "left_semi")
        met = matched(change, old, self.by, "left")
        was = {c: F.coalesce(f"_was_{c}", F.lit(0)).cast(state.schema[c].dataType) for c in self.figures}
        now = {c: (F.col(c) + was[c]).cast(state.schema[c].dataType) for c in self.figures}
        op = F.when(was[ROWS] == 0, "insert").when(now[ROWS] == 0, "delete").otherwise("update")
        return met.select(
            *self.by,
            *[now[c].alias(c) for c in self.figures],
            *[was[c].alias(f"_was_{c}") for c in self.figures],
            op.alias("_op"),
        )

    def applied(self, state: DataFrame, changes: DataFrame) -> DataFrame:
        """The state after changes; groups without rows are gone."""
        kept = matched(state, changes.select(*self.by), self.by, "left_anti")
        return kept.unionByName(changes.where("_op <> 'delete'").select(*state.columns))

    def value(self, name: str) -> Column:
        """A sum as SQL has it: null where no row had a value."""
        return F.when(F.col(f"{name}_n") > 0, F.col(name))

    def rolled_up(self, by: Sequence[str], distinct: str, counted: Value | None = None) -> RolledUp:
        """The coarser table of the same sums; ``distinct`` counts the groups of this one (where ``counted``)."""
        return RolledUp(by, self.sums, distinct, counted or (lambda: F.lit(True)))


class RolledUp(Sums):
    """A table of sums over the groups of a finer one, which it counts as well."""

    def __init__(self, by: Sequence[str], sums: Mapping[str, tuple[Value, str]], distinct: str, counted: Value):
        super().__init__(by, sums)
        self.below = list(self.figures)
        self.figures = [*self.below, distinct]
        self.distinct, self.counted = distinct, counted

    def over(self, groups: DataFrame) -> DataFrame:
        """Figures from all groups below."""
        one = F.when(self.counted(), 1).otherwise(0).cast("bigint")
        sums = [F.sum(c).cast(groups.schema[c].dataType).alias(c) for c in self.below]
        return groups.groupBy(*self.by).agg(*sums, F.sum(one).alias(self.distinct))

    def over_changes(self, changes: DataFrame) -> DataFrame:
        """What changes of the groups below do to the figures."""
        present = lambda c: F.when(F.col(c) > 0, 1).otherwise(0)
        one = F.when(self.counted(), present(ROWS) - present(f"_was_{ROWS}")).otherwise(0)
        moved = changes.select(
            *self.by, *[(F.col(c) - F.col(f"_was_{c}")).alias(c) for c in self.below], one.cast("bigint").alias(self.distinct)
        )
        return self._nonzero(moved.groupBy(*self.by).agg(*[F.sum(c).alias(c) for c in self.figures]))
