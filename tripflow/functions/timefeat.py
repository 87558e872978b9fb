"""Calendar and cyclical time features (F1-F4, F6, F7) as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.schema import RUSH_HOURS, WEEKEND_DAYS



def as_timestamp(col: Column, dtype: T.DataType) -> Column:
    """Parse a pickup/dropoff column to TIMESTAMP_NTZ; strings must parse (ANSI raises)."""
    if isinstance(dtype, T.StringType):
        return F.to_timestamp_ntz(col)
    if isinstance(dtype, T.TimestampNTZType):
        return col
    return col.cast(T.TimestampNTZType())


def to_second(col: Column) -> Column:
    """Truncate to whole seconds, as formatting to 'YYYY-MM-DD HH:MM:SS' and parsing back does.

    Built from the wall-clock fields, so it never passes through the session time zone
    (``date_trunc`` would, and shifts wall-clock times that fall into a DST gap).
    """
    return F.make_timestamp_ntz(F.year(col), F.month(col), F.dayofmonth(col), F.hour(col), F.minute(col),
                                F.second(col).cast("decimal(8,6)"))


def _fraction_micros(col: Column) -> Column:
    """Microseconds within the second (0..999999) of a wall-clock timestamp."""
    return ((F.extract(F.lit("SECOND"), col) * 1_000_000).cast("bigint") % 1_000_000).cast("int")


def ntz_micros(col: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a wall-clock (NTZ) timestamp, from its fields.

    ``timestamp_diff`` / ``unix_micros`` pass through the session time zone and shift
    wall-clock values across DST changes; the date and time fields do not.
    """
    days = F.unix_date(F.to_date(col)).cast("bigint")
    seconds = (F.extract(F.lit("SECOND"), col) * 1_000_000).cast("bigint")
    return (days * 86_400_000_000 + F.hour(col).cast("bigint") * 3_600_000_000
            + F.minute(col).cast("bigint") * 60_000_000 + seconds)


def wall_diff_micros(start: Column, end: Column) -> Column:
    """end - start in microseconds of wall-clock time."""
    return ntz_micros(end) - ntz_micros(start)


def format_ntz(col: Column, pattern: str = "%04d-%02d-%02d %02d:%02d:%02d", micros: bool = False) -> Column:
    """Text of a wall-clock timestamp from its fields (``date_format`` goes through the session zone).

    ``pattern`` is a printf pattern over (year, month, day, hour, minute, second[, microsecond]).
    """
    fields = [F.year(col), F.month(col), F.dayofmonth(col), F.hour(col), F.minute(col), F.second(col)]
    if micros:
        fields.append(_fraction_micros(col))
    return F.when(col.isNotNull(), F.format_string(pattern, *fields))


def format_second(col: Column) -> Column:
    """'YYYY-MM-DD HH:MM:SS' (fractions truncated)."""
    return format_ntz(col)


def format_micros(col: Column) -> Column:
    """'YYYY-MM-DD HH:MM:SS.ffffff'."""
    return format_ntz(col, "%04d-%02d-%02d %02d:%02d:%02d.%06d", micros=True)


def hour(col: Column) -> Column:
    return F.hour(col)


def weekday_monday0(col: Column) -> Column:
    """Day of week with Monday = 0 (``dayofweek`` is Sunday = 1 and is not used)."""
    return F.weekday(col)


def cyclical(value: Column, period: float) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def is_weekend(day_of_week: Column) -> Column:
    return day_of_week.isin(WEEKEND_DAYS).cast("int")


def is_rush_hour(hour_col: Column) -> Column:
    return hour_col.isin(RUSH_HOURS).cast("int")
