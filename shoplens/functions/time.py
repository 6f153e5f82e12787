"""Time helpers: as-of literal, calendar-day age, age windows, ISO-8601 'Z' text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoplens.config import as_of_text

ISO_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DATE_FORMAT = "yyyy-MM-dd"

# Age windows in calendar days (inclusive bounds). "15_30d" covers ages
# 14..29, as the original job defines it despite its name.
AGE_WINDOWS = {
    "7d": (0, 6),
    "14d": (0, 13),
    "15_30d": (14, 29),
    "30d": (0, 29),
}


def as_of_col(as_of=None) -> Column:
    """The job's reference time. One literal for the whole plan; ``None``
    falls back to ``current_timestamp()`` (fixed once per query)."""
    text = as_of_text(as_of)
    if text is None:
        return F.current_timestamp()
    return F.to_timestamp(F.lit(text))


def as_of_sql(as_of=None) -> str:
    """``as_of`` as a SQL expression (a timestamp literal)."""
    text = as_of_text(as_of)
    return "current_timestamp()" if text is None else f"TIMESTAMP '{text}'"


def age_days(ts: Column, as_of=None) -> Column:
    """Whole calendar days between ``ts`` and ``as_of`` in the session time
    zone (23:59:59 to the next 00:00:01 counts 1). Future is negative."""
    return F.datediff(as_of_col(as_of), ts)


def in_window(age: Column, window: str) -> Column:
    lo, hi = AGE_WINDOWS[window]
    return age.between(lo, hi)


def ts_range_for_window(ts: Column, as_of, window: str) -> Column:
    """Same rows as ``in_window(age_days(ts))`` but written on the raw column,
    so a parquet scan can prune row groups (ts >= day(as_of)-hi, ts < day(as_of)-lo+1)."""
    lo, hi = AGE_WINDOWS[window]
    day = F.to_date(as_of_col(as_of))
    start = F.to_timestamp(F.date_sub(day, hi))
    end = F.to_timestamp(F.date_sub(day, lo - 1))
    return (ts >= start) & (ts < end)


def ts_range_sql(ts: str, as_of, window: str) -> str:
    """SQL form of ``ts_range_for_window`` for column name ``ts``."""
    lo, hi = AGE_WINDOWS[window]
    day = f"to_date({as_of_sql(as_of)})"
    return (f"({ts} >= CAST(date_sub({day}, {hi}) AS TIMESTAMP) AND "
            f"{ts} < CAST(date_sub({day}, {lo - 1}) AS TIMESTAMP))")


def format_iso_z(ts: Column) -> Column:
    return F.date_format(ts, ISO_Z_FORMAT)


def parse_iso_z(text: Column) -> Column:
    """Text -> timestamp; malformed text gives NULL instead of an error."""
    return F.try_to_timestamp(text, F.lit(ISO_Z_FORMAT))


def parse_date(text: Column) -> Column:
    """'yyyy-MM-dd' text -> date; malformed text gives NULL."""
    return F.try_to_date(text, DATE_FORMAT)
