"""Time helpers that behave the same on TIMESTAMP and TIMESTAMP_NTZ columns.

``cast(ts as long)`` is refused for NTZ, so durations use ``unix_timestamp``; day truncation
returns ``date`` so both engines compare the same type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(ts: Column | str) -> Column:
    """``date_trunc('day', ts)`` as a ``date``."""
    return F.to_date(_c(ts))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end`` (negative when end is earlier)."""
    return F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))


def year_month(ts: Column | str) -> Column:
    """``yyyy-MM`` text of a timestamp."""
    return F.date_format(_c(ts), "yyyy-MM")


def month_of(year: Column | str, month: Column | str) -> Column:
    """First day of a (year, month) as a date."""
    return F.make_date(_c(year), _c(month), F.lit(1))


def month_start(ts: Column | str) -> Column:
    """First instant of the timestamp's month, as TIMESTAMP_NTZ (date arithmetic only)."""
    return F.trunc(_c(ts), "month").cast("timestamp_ntz")


def month_end(ts: Column | str) -> Column:
    """Last whole second of the timestamp's month (``<= end`` keeps 23:59:59 itself)."""
    return F.last_day(_c(ts)).cast("timestamp_ntz") + F.expr("INTERVAL 86399 SECONDS")
