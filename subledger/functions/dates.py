"""Timestamp and date expressions.

Timestamps stay ``TIMESTAMP_NTZ``: a string cast keeps the wall clock and drops
any zone suffix, which is what the reference does with ``tz_localize(None)``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from subledger.functions.blank import _col, is_blank


def shift_hours(ts: Column, hours: int) -> Column:
    """Fixed shift (not DST-aware); the result stays TIMESTAMP_NTZ."""
    if not hours:
        return ts
    return ts + F.make_dt_interval(hours=F.lit(int(hours)))


def parse_ts_strict(c: Column | str, shift: int = 0) -> Column:
    """Parse; a blank value is NULL, any other unparseable value fails the job (ANSI cast)."""
    c = _col(c)
    return shift_hours(F.when(~is_blank(F.trim(c)), c).cast("timestamp_ntz"), shift)


def parse_ts_lenient(c: Column | str, shift: int = 0) -> Column:
    """Parse; '' and garbage become NULL."""
    return shift_hours(_col(c).try_cast("timestamp_ntz"), shift)


def ntz_literal(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal independent of the Python process's zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def date_literal(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def epoch_to_local_date(epoch: Column | str, timezone: str = "UTC") -> Column:
    """Unix seconds -> calendar date in ``timezone``.

    Built as a UTC wall clock (TIMESTAMP_NTZ arithmetic) and converted with
    ``convert_timezone``, so the result never depends on the session zone.
    """
    epoch_ntz = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc_wall = epoch_ntz + F.make_dt_interval(secs=_col(epoch).cast("decimal(18,0)"))
    if timezone == "UTC":
        return F.to_date(utc_wall)
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(timezone), utc_wall))


def month_name(d: Column, names: Sequence[str]) -> Column:
    """Month number of ``d`` -> ``names[month-1]``; NULL date -> ''."""
    pairs = []
    for i, name in enumerate(names, start=1):
        pairs += [F.lit(i), F.lit(name)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.month(d)), F.lit(""))
