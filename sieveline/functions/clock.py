"""Time buckets, spans and calendar tests for zoned and zone-less timestamps alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600.0


def bucket_start(ts: Column | str, width: str) -> Column:
    """Start of the epoch-aligned tumbling bucket of ``width`` that holds ``ts``."""
    return F.window(ts, width)["start"]


def calendar_start(df: DataFrame, ts: str, unit: str) -> Column:
    """``date_trunc`` that keeps the column's own timestamp type (zoned or not)."""
    return F.date_trunc(unit, F.col(ts)).cast(df.schema[ts].dataType)


def shift(ts: Column, width: str, steps: int = 1) -> Column:
    """``ts`` moved by ``steps`` times ``width`` (negative steps move it back)."""
    moved = ts
    for _ in range(abs(steps)):
        moved = moved + F.expr(f"INTERVAL {width}") if steps > 0 else moved - F.expr(f"INTERVAL {width}")
    return moved


def span_seconds(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end``, exact to the microsecond, in any session zone."""
    span = end - start

    def part(name: str) -> Column:
        return F.extract(F.lit(name), span)

    whole = part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60
    return whole.cast("double") + part("SECOND").cast("double")


def span_hours(start: Column, end: Column) -> Column:
    return span_seconds(start, end) / SECONDS_PER_HOUR


def minute_boundaries(start: Column, end: Column) -> Column:
    """Number of clock-minute boundaries crossed between two instants."""

    def second_of_minute(ts: Column) -> Column:
        return F.extract(F.lit("SECOND"), ts).cast("double")

    aligned = span_seconds(start, end) + second_of_minute(start) - second_of_minute(end)
    return F.round(aligned / 60.0).cast("bigint")


def weekday_sunday0(ts: Column) -> Column:
    """Day of week with Sunday as 0."""
    return F.dayofweek(ts) - 1


def business_hours(ts: Column, first_hour: int = 9, last_hour: int = 17) -> Column:
    """Monday to Friday, ``first_hour`` to ``last_hour`` inclusive."""
    return weekday_sunday0(ts).between(1, 5) & F.hour(ts).between(first_hour, last_hour)
