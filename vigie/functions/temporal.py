"""Calendar expressions that never leave zone-less time.

``timestamp_ntz`` values are turned into dates by a cast; nothing here goes through
the session time zone, so results do not depend on it.
"""

from __future__ import annotations


def day(ts: str) -> str:
    return f"cast({ts} AS date)"


def month_start(ts: str) -> str:
    return f"trunc({day(ts)}, 'month')"


def year_number(ts: str) -> str:
    return f"cast(year({day(ts)}) AS bigint)"


def month_number(ts: str) -> str:
    return f"cast(month({day(ts)}) AS bigint)"


def weekday_sunday0(ts: str) -> str:
    return f"cast(dayofweek({day(ts)}) - 1 AS bigint)"


def weekday_padded(ts: str) -> str:
    """English day name padded to nine characters."""
    return f"rpad(date_format({day(ts)}, 'EEEE'), 9, ' ')"


def month_index(month: str) -> str:
    """Consecutive number of a calendar month, for range windows."""
    return f"(year({month}) * 12 + month({month}))"


def seconds_between(start: str, end: str) -> str:
    """Signed whole seconds from ``start`` to ``end`` (both zone-less)."""
    return f"cast(cast({end} - {start} AS interval second) AS bigint)"


def week_closing_sunday(ts: str) -> str:
    return f"date_add({day(ts)}, 6 - weekday({day(ts)}))"


def period_start(ts: str, granularity: str) -> str:
    """First day of the day/ISO week/month/year; unknown names mean month."""
    if granularity == "day":
        return day(ts)
    unit = granularity if granularity in ("week", "month", "year") else "month"
    return f"trunc({day(ts)}, '{unit}')"
