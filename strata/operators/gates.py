"""Quality gates. All gates on one table are answered by one pass over it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


class GateFailure(Exception):
    """At least one gate failed; the message names each of them."""


@dataclass(frozen=True)
class Gate:
    """``kind`` is ``row_count_min``, ``pk_unique`` or ``null_ratio_max``."""

    kind: str
    column: str = ""
    limit: float = 0


def at_least(rows: int) -> Gate:
    return Gate("row_count_min", limit=rows)


def unique(key: str) -> Gate:
    return Gate("pk_unique", key)


def mostly_set(column: str, ratio: float) -> Gate:
    return Gate("null_ratio_max", column, ratio)


def _verdict(gate: Gate, table: str) -> Column:
    """One result row from the measured columns of a table."""
    if gate.kind == "row_count_min":
        seen, shown = F.col("_rows"), F.col("_rows").cast("string")
        passed, wanted = seen >= int(gate.limit), f">={int(gate.limit)}"
    elif gate.kind == "pk_unique":
        seen = F.col("_repeated")
        shown = F.concat(seen.cast("string"), F.lit(" duplicate keys"))
        passed, wanted = seen == 0, "0"
    else:
        share = F.col(f"_nulls_{gate.column}") / F.col("_rows")
        seen = F.when(F.col("_rows") > 0, share).otherwise(F.lit(0.0))
        shown = F.format_string("%.4f", seen)
        passed, wanted = seen <= gate.limit, f"<={gate.limit}"
        table = f"{table}.{gate.column}"
    return F.struct(
        F.lit(gate.kind).alias("gate"),
        F.lit(table).alias("table_name"),
        passed.alias("passed"),
        shown.alias("observed"),
        F.lit(wanted).alias("expected"),
    )


def check_table(df: DataFrame, table: str, gates: Sequence[Gate]) -> DataFrame:
    """Result rows (gate, table_name, passed, observed, expected).

    With a uniqueness gate the pass groups by the key, where NULL keys form one
    group, and rolls the groups up; map tasks combine equal keys before the
    shuffle. Counts of different keys need a pass each.
    """
    keys = list(dict.fromkeys(g.column for g in gates if g.kind == "pk_unique"))
    plain = [g for g in gates if g.kind != "pk_unique"]
    reports = []
    for position, key in enumerate(keys or [None]):
        batch = [g for g in gates if g.kind == "pk_unique" and g.column == key]
        batch += plain if position == 0 else []
        reports.append(_measure(df, table, key, batch))
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def _measure(df: DataFrame, table: str, key: str | None, gates: Sequence[Gate]) -> DataFrame:
    checked = sorted({g.column for g in gates if g.kind == "null_ratio_max"})
    counted = [F.count(F.lit(1)).alias("_rows")]
    counted += [F.count_if(F.col(c).isNull()).alias(f"_nulls_{c}") for c in checked]
    if key is None:
        measured = df.agg(*counted)
    else:
        names = ["_rows", *[f"_nulls_{c}" for c in checked]]
        measured = (
            df.groupBy(F.col(key).alias("_key"))
            .agg(*counted)
            .agg(
                F.count_if(F.col("_rows") > 1).alias("_repeated"),
                *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
            )
        )
    return measured.select(F.explode(F.array(*[_verdict(g, table) for g in gates])).alias("_r")).select(
        "_r.*"
    )


def standard_gates(orders: DataFrame, customers: DataFrame, fact: DataFrame) -> DataFrame:
    """Default checks after a refresh of silver and gold."""
    current = customers.where("is_current")
    return (
        check_table(orders, "silver.orders", [at_least(1), unique("order_id")])
        .unionByName(check_table(current, "silver.customers[current]", [unique("customer_id")]))
        .unionByName(
            check_table(
                fact,
                "gold.fact_sales",
                [
                    at_least(1),
                    unique("order_line_id"),
                    mostly_set("customer_sk", 0.0),
                    mostly_set("product_sk", 0.01),
                ],
            )
        )
    )


def both_sources(fact: DataFrame, volume: DataFrame) -> DataFrame:
    """Whether gold is fed by the database (fact) and by the file drops (volume)."""
    sides = fact.agg(F.count(F.lit(1)).alias("fact_rows"), F.lit(0).alias("volume_rows"))
    files = volume.agg(F.lit(0).alias("fact_rows"), F.count(F.lit(1)).alias("volume_rows"))
    return (
        sides.unionByName(files)
        .agg(F.sum("fact_rows").alias("fact_rows"), F.sum("volume_rows").alias("volume_rows"))
        .withColumn("passed", (F.col("fact_rows") > 0) & (F.col("volume_rows") > 0))
    )


def as_metrics(results: Sequence[Row]) -> dict[str, str]:
    return {
        f"{r['gate']}:{r['table_name']}": (
            f"{'pass' if r['passed'] else 'FAIL'} observed={r['observed']} expected={r['expected']}"
        )
        for r in results
    }


def require_passed(results: Sequence[Row]) -> None:
    failed = [f"{r['gate']}({r['table_name']})" for r in results if not r["passed"]]
    if failed:
        raise GateFailure("failed gates: " + "; ".join(failed))
