"""Rows met by their keys: what merges and histories share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import is_metadata


def matched(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys of which a null equals a null; the keys of ``other`` do not come along."""
    named = {k: f"_key_{k}" for k in keys}
    same = F.lit(True)
    for k, name in named.items():
        same = same & F.col(k).eqNullSafe(F.col(name))
    return rows.join(other.withColumnsRenamed(named), same, how).drop(*named.values())


def widened(rows: DataFrame, wider: DataFrame) -> DataFrame:
    """The rows with a null column for each one that only ``wider`` has."""
    known = {c.lower() for c in rows.columns}
    added = {f.name: F.lit(None).cast(f.dataType) for f in wider.schema if f.name.lower() not in known}
    return rows.withColumns(added) if added else rows


def touched_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    return matched(target, updates.select(*keys), keys, "left_semi")


def business_columns(df: DataFrame, *excluded: str) -> list[str]:
    return [c for c in df.columns if not is_metadata(c) and c not in excluded]
