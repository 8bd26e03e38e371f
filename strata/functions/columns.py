"""Column expressions shared by the operators. All are Spark built-ins."""

from __future__ import annotations

import calendar
from collections.abc import Iterable, Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_metadata(name: str) -> bool:
    """``_``-prefixed columns describe the load and never the business row."""
    return name.startswith("_")


def surrogate_key(*columns: str) -> Column:
    return F.xxhash64(*columns)


def date_number(day: Column | str) -> Column:
    """A date as the integer yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def line_net(quantity: str, unit_price: str, discount_pct: str) -> Column:
    """Net value of a line, exact in decimals; NULL if it exceeds 14 digits."""
    gross = F.col(quantity) * F.col(unit_price)
    kept = (F.lit(100) - F.col(discount_pct)) * F.lit(Decimal("0.01"))
    return (gross * kept).try_cast("decimal(14,2)")


def money(column: Column, precision: int = 18) -> Column:
    return column.cast(f"decimal({precision},2)")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; NULL when whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def differs(left: Iterable[Column], right: Iterable[Column]) -> Column:
    """True when any pair differs, NULL being a value like any other."""
    verdict = F.lit(False)
    for a, b in zip(left, right, strict=True):
        verdict = verdict | ~a.eqNullSafe(b)
    return verdict


def within_month(column: str, year: int, month: int) -> Column:
    """Month filter as a plain range, so that scans can prune on it."""
    last = calendar.monthrange(year, month)[1]
    return F.col(column).between(F.lit(date(year, month, 1)), F.lit(date(year, month, last)))


def moment(value: datetime, kind: T.DataType) -> Column:
    """A time literal of the given type; zone-free types take the digits as they are."""
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value).cast(kind)


def trailing_days(column: str, as_of: date, days: int) -> Column:
    return F.col(column) >= F.date_sub(F.lit(as_of), days)


def hash_slot(keys: Sequence[Column | str], slots: int, salt: int | None = None) -> Column:
    """Stable slot number 0..slots-1 for a key."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    if salt is not None:
        parts.append(F.lit(salt))
    return F.pmod(F.xxhash64(*parts), F.lit(slots))


def interleave_bits(ranks: Sequence[Column], bits: int) -> Column:
    """Morton number of small integer ranks."""
    code = F.lit(0).cast("bigint")
    width = len(ranks)
    for bit in range(bits):
        for position, rank in enumerate(ranks):
            picked = F.shiftright(rank.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            code = code.bitwiseOR(F.shiftleft(picked, bit * width + position))
    return code
