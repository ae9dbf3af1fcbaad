"""Scalar expressions used inside the operators (all built-in, codegen'd)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of",
    "title_case",
    "display_ratio",
    "round_half_even",
    "parse_ts",
    "ts_literal",
    "compose_datetime",
    "to_utc",
    "utc_instant",
    "utc_wall_clock",
    "ts_as",
    "utc_day",
    "utc_hour",
    "time_of_day",
    "time_label",
    "age_seconds",
    "count_true",
    "truncate_int",
]

# Time label formats by display unit (hours -> HH:mm, minutes -> HH:mm:ss).
TIME_LABEL_FORMATS = {"hours": "HH:mm", "minutes": "HH:mm:ss"}


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c) -> Column:
    """Capitalise the first letter of each word (colour names)."""
    return F.initcap(col_of(c))


def display_ratio(num, den) -> Column:
    """``"<num>/<den>"`` label."""
    return F.concat_ws("/", col_of(num).cast("string"), col_of(den).cast("string"))


def round_half_even(c, scale: int = 1) -> Column:
    """Banker's rounding (what numpy/pandas ``round`` does)."""
    return F.bround(col_of(c), scale)


def ts_literal(value) -> Column:
    """Timestamp literal without zone (compares with timestamp_ntz columns).

    Accepts ``datetime`` or ISO text (``2024-01-10 00:00:00``,
    ``2024-01-10T00:00:00Z``). Zone suffixes are read as UTC.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    text = str(value).replace("T", " ").rstrip("Z")
    return F.lit(text).cast("timestamp_ntz")


def parse_ts(c, fmt: str | None = None) -> Column:
    """Parse datetime text (UTC) into a timestamp."""
    return F.to_timestamp(col_of(c), fmt) if fmt else F.to_timestamp(col_of(c))


def compose_datetime(date_col, time_col) -> Column:
    """Combine a date and a time-of-day into one timestamp_ntz."""
    return F.concat_ws(" ", col_of(date_col).cast("string"),
                       col_of(time_col).cast("string")).cast("timestamp_ntz")


def to_utc(c, tz: str = "UTC") -> Column:
    """The UTC wall clock (zone-less) of a zone-less wall clock in ``tz``,
    whatever the session time zone."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), col_of(c).cast("timestamp_ntz"))


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def utc_instant(c) -> Column:
    """Instant (``timestamp``) of a zone-less wall clock read as UTC,
    whatever the session time zone (a plain cast would read it in the
    session zone)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), col_of(c)))


def utc_wall_clock(c) -> Column:
    """Zone-less UTC wall clock (``timestamp_ntz``) of an instant, whatever
    the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col_of(c)), _epoch_ntz())


def utc_hour(c) -> Column:
    """Hours since 1970-01-01 00:00 UTC of an instant, as BIGINT (no session zone involved)."""
    return F.floor(F.unix_micros(col_of(c)) / F.lit(3_600_000_000)).cast("long")


def utc_day(c) -> Column:
    """UTC date of an instant, whatever the session time zone."""
    days = F.floor(F.unix_micros(col_of(c)) / F.lit(86_400_000_000)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def ts_as(value, ts_type: str = "timestamp_ntz") -> Column:
    """A time bound of type ``ts_type`` (``timestamp`` or
    ``timestamp_ntz``): ``None`` is the current time, text or ``datetime`` is
    read as UTC wall clock, a Column is cast. Unlike casting a zone-less
    literal, the result does not depend on the session time zone."""
    if isinstance(value, Column):
        return value.cast(ts_type)
    if value is None:
        now = F.current_timestamp()
        return now if ts_type == "timestamp" else utc_wall_clock(now)
    lit = ts_literal(value)
    return utc_instant(lit) if ts_type == "timestamp" else lit


def time_of_day(c) -> Column:
    return F.date_format(col_of(c), "HH:mm:ss")


def time_label(c, unit: str = "minutes") -> Column:
    return F.date_format(col_of(c), TIME_LABEL_FORMATS[unit])


def age_seconds(latest, now) -> Column:
    """Seconds from ``latest`` to ``now`` as DOUBLE (microsecond exact)."""
    return F.timestamp_diff("MICROSECOND", col_of(latest), col_of(now)) / F.lit(1e6)


def count_true(c) -> Column:
    """Count of rows where ``c`` is true; NULL and false are not counted."""
    return F.count_if(col_of(c))


def truncate_int(c) -> Column:
    """Truncate toward zero to INT (what ``astype(int)`` does)."""
    return col_of(c).cast("int")
