"""Column expressions shared by the operators.

All times are ``timestamp_ntz`` so the session time zone never changes a result.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model: the open-ended validity bound and the version flags.
INF_TEXT = "9999-12-31 00:00:00"
FLAG_LIVE = "n"
FLAG_DELETED = "y"


def ntz(value: str | dt.datetime | dt.date) -> Column:
    """A ``timestamp_ntz`` literal (constant-folded by Catalyst, time-zone free)."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.expr(f"TIMESTAMP_NTZ '{value}'")


def inf() -> Column:
    """The open-ended ``effective_to`` of a current version."""
    return ntz(INF_TEXT)


def one_second() -> Column:
    return F.lit(dt.timedelta(seconds=1))


def as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def day_bounds(day: str | dt.date) -> tuple[Column, Column]:
    """``[day 00:00, day+1 00:00)`` as NTZ literals."""
    d = as_date(day)
    return ntz(d), ntz(d + dt.timedelta(days=1))


def on_day(ts: Column | str, day: str | dt.date) -> Column:
    """``cast(ts as date) = day`` written as a half-open range so it reaches the Parquet scan."""
    d = as_date(day)
    if isinstance(ts, str):
        return F.expr(f"{ts} >= TIMESTAMP_NTZ '{d} 00:00:00' AND {ts} < TIMESTAMP_NTZ '{d + dt.timedelta(days=1)} 00:00:00'")
    lo, hi = day_bounds(day)
    return (ts >= lo) & (ts < hi)


FULL_NAME_SQL = "last_name || ' ' || first_name || ' ' || patronymic"


def full_name() -> Column:
    """``last || ' ' || first || ' ' || middle``: NULL if any part is NULL (``||`` is ``concat``, not ``concat_ws``)."""
    return F.expr(FULL_NAME_SQL)


def null_safe_differs(pairs: list[tuple[Column, Column]]) -> Column:
    """True when any attribute pair differs, NULL-vs-value counting as a difference and NULL = NULL not."""
    return reduce(or_, [~a.eqNullSafe(b) for a, b in pairs], F.lit(False))


def epoch_seconds_sql(ts: str) -> str:
    """Whole seconds since 1970-01-01 00:00:00 of an NTZ timestamp column, from its date and clock fields
    only (``timestampdiff``/``unix_timestamp`` would pass through the session time zone and its DST)."""
    return (f"(CAST(datediff(to_date({ts}), DATE'1970-01-01') AS BIGINT) * 86400 + hour({ts}) * 3600"
            f" + minute({ts}) * 60 + CAST(floor(second({ts})) AS BIGINT))")


def epoch_seconds(ts: str) -> Column:
    return F.expr(epoch_seconds_sql(ts))
