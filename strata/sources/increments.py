"""Incremental extracts from databases and tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import moment

MODIFIED = "modified_at"


def since(df: DataFrame, column: str, mark: datetime) -> DataFrame:
    """Rows at or after the mark.

    Rows exactly on the mark come again, because a commit with an equal time
    can arrive later; merging them twice changes nothing.
    """
    return df.where(F.col(column) >= moment(mark, df.schema[column].dataType))


def stamp_load(df: DataFrame, table: str, system: str = "database") -> DataFrame:
    return df.withColumns(
        {
            "_ingest_ts": F.current_timestamp(),
            "_source_system": F.lit(system),
            "_source_table": F.lit(table),
        }
    )


@dataclass(frozen=True)
class JdbcSource:
    """A database read over JDBC; the caller supplies driver and credentials."""

    url: str
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = ""
    schema: str = ""
    fetch_size: int = 10_000
    tasks: int = 16

    def table_name(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table

    def increment_sql(self, table: str, mark: datetime) -> str:
        """Statement the database runs, so that only changed rows travel."""
        return f"SELECT * {self._since(table, mark)}"

    def span_sql(self, table: str, mark: datetime) -> str:
        """Statement for the oldest and the newest modification since the mark."""
        return f"SELECT MIN({MODIFIED}) AS oldest, MAX({MODIFIED}) AS newest {self._since(table, mark)}"

    def _since(self, table: str, mark: datetime) -> str:
        moment = mark.isoformat(sep=" ", timespec="microseconds")
        return f"FROM {self.table_name(table)} WHERE {MODIFIED} >= '{moment}'"

    def options(self) -> dict[str, str]:
        given = {"url": self.url, "fetchsize": str(self.fetch_size)}
        for name in ("user", "password", "driver"):
            if getattr(self, name):
                given[name] = getattr(self, name)
        return given

    def slices(self, mark: datetime, edges: Sequence[datetime]) -> list[str]:
        """Conditions that cut the increment by modification time, one task each."""
        stamps = [mark, *sorted(e for e in edges if e > mark)]
        quoted = [f"'{t.isoformat(sep=' ', timespec='microseconds')}'" for t in stamps]
        parts = [
            f"{MODIFIED} >= {low} AND {MODIFIED} < {high}"
            for low, high in zip(quoted, quoted[1:], strict=False)
        ]
        return [*parts, f"{MODIFIED} >= {quoted[-1]}"]

    def bounds_sql(self, table: str, mark: datetime, key: str) -> str:
        """Statement for the (modification, key) at which every further one of ``tasks`` equal slices begins."""
        order = f"OVER (ORDER BY {MODIFIED}, {key})"
        tiles = f"SELECT {MODIFIED}, {key}, NTILE({self.tasks}) {order} AS tile {self._since(table, mark)}"
        steps = f"SELECT {MODIFIED}, {key}, tile, LAG(tile) {order} AS tile_before FROM ({tiles}) tiles"
        return f"SELECT {MODIFIED}, {key} FROM ({steps}) steps WHERE tile_before < tile"

    def key_slices(self, mark: datetime, bounds: Sequence[tuple[datetime, object]], key: str) -> list[str]:
        """Conditions that cut the increment at bounds of time and key, so that rows of one time are cut as well.

        Each row meets one condition. The plain ranges of time let the source
        use an index on it. The key is unique and has no nulls.
        """
        starts, cuts = [f"{MODIFIED} >= {_quoted(mark)}"], []
        for at, value in sorted(bounds):
            t, k = _quoted(at), _quoted(value)
            cuts.append(f"{MODIFIED} <= {t} AND ({MODIFIED} < {t} OR {key} < {k})")
            starts.append(f"{MODIFIED} >= {t} AND ({MODIFIED} > {t} OR {key} >= {k})")
        return [" AND ".join(both) for both in zip(starts, [*cuts, "1 = 1"], strict=True)]

    def read_increment(
        self,
        spark: SparkSession,
        table: str,
        mark: datetime,
        edges: Sequence[datetime] | None = None,
        key: str | None = None,
    ) -> DataFrame:
        """Changed rows of a table, read in parallel between the ``edges``.

        With a unique ``key`` the database names bounds of equal slices, which
        hold for a load with one modification time, too.
        Without edges the database is asked for the span of the increment, which
        is cut into ``tasks`` equal pieces; an empty list reads in one task.
        """
        if key and edges is None and self.tasks > 1:
            bounds = [tuple(row) for row in self._load(spark, self.bounds_sql(table, mark, key)).collect()]  # tasks - 1 rows
            return self._sliced(spark, table, self.key_slices(mark, bounds, key))
        if edges is None and self.tasks > 1:
            edges = even_edges(*self._load(spark, self.span_sql(table, mark)).first(), self.tasks)
        if edges:
            return self._sliced(spark, table, self.slices(mark, edges))
        return self._load(spark, self.increment_sql(table, mark))

    def _sliced(self, spark: SparkSession, table: str, conditions: list[str]) -> DataFrame:
        properties = {k: v for k, v in self.options().items() if k != "url"}
        return spark.read.jdbc(self.url, self.table_name(table), predicates=conditions, properties=properties)

    def _load(self, spark: SparkSession, query: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options()).option("query", query).load()


def _quoted(value: object) -> str:
    """A value as SQL text; numbers as they are."""
    if isinstance(value, datetime):
        return f"'{value.isoformat(sep=' ', timespec='microseconds')}'"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def even_edges(oldest: datetime | None, newest: datetime | None, pieces: int) -> list[datetime]:
    """Times that cut a span into equal pieces; none where there is no span."""
    if oldest is None or newest is None or oldest == newest:
        return []
    return [oldest + (newest - oldest) * k / pieces for k in range(1, pieces)]
