"""Time expressions: buckets, horizons, shifts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000


def as_utc(value: datetime) -> datetime:
    """Naive times are UTC."""
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def floor_value(value: datetime, minutes: int) -> datetime:
    """Floor a driver-side range bound to the epoch-aligned grid."""
    value = as_utc(value)
    step = minutes * 60
    seconds = int(value.timestamp() // step) * step
    return datetime.fromtimestamp(seconds, timezone.utc)


def grid_size(start: datetime, end: datetime, minutes: int) -> int:
    """Grid points from ``start`` to ``end``, both floored and included."""
    span = floor_value(end, minutes) - floor_value(start, minutes)
    return int(span / timedelta(minutes=minutes)) + 1


def bucket(time: Column, minutes: int | Column) -> Column:
    """Left edge of the epoch-aligned bucket; one width, or a column of widths."""
    width = F.lit(minutes * 60) if isinstance(minutes, int) else minutes * F.lit(60)
    seconds = F.unix_seconds(time)
    return F.timestamp_seconds(seconds - F.pmod(seconds, width))


def floor_within_hour(time: Column, minutes: int | Column) -> Column:
    """Floor the minute of the hour to a multiple of ``minutes``."""
    width = F.lit(minutes) if isinstance(minutes, int) else minutes
    seconds = F.unix_seconds(time)
    minute = F.floor(F.pmod(seconds, F.lit(3600)) / F.lit(60))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(3600)) + (minute - F.pmod(minute, width)) * F.lit(60))


def shift(time: Column, minutes: int) -> Column:
    """Move an instant by whole minutes, negative for earlier."""
    return F.timestamp_micros(F.unix_micros(time) + F.lit(minutes * 60_000_000))


def hours_before(time: Column, hours: Column) -> Column:
    """The instant ``hours`` earlier; fractions and negative hours allowed."""
    return F.timestamp_micros(F.unix_micros(time) - F.round(hours * F.lit(float(MICROS_PER_HOUR))).cast("bigint"))


def horizon_hours(target: Column, created: Column) -> Column:
    """Hours from ``created`` to ``target``, fractional."""
    return (F.unix_micros(target) - F.unix_micros(created)) / F.lit(float(MICROS_PER_HOUR))


def round_down_horizon(hours: Column, options: Sequence[float]) -> Column:
    """Largest option strictly below ``hours``; null where there is none.

    A chain of comparisons rather than a filtered array: it stays in generated code.
    """
    result = F.lit(None).cast("double")
    for option in sorted({float(o) for o in options}):
        result = F.when(hours > F.lit(option), F.lit(option)).otherwise(result)
    return F.when(F.isnan(hours), F.lit(None).cast("double")).otherwise(result)


def offset_text(time: Column, zone: str = "CET") -> Column:
    """Local ISO text with an offset without colon, as ``2019-10-16T22:00:00+0200``."""
    local = F.from_utc_timestamp(time, zone)
    minutes = (F.unix_seconds(local) - F.unix_seconds(time)) / F.lit(60)
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    size = F.abs(minutes).cast("int")
    hours = F.lpad(F.floor(size / F.lit(60)).cast("string"), 2, "0")
    rest = F.lpad(F.pmod(size, F.lit(60)).cast("string"), 2, "0")
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), sign, hours, rest)
