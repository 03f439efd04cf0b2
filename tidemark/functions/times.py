"""Dates and times as columns (E1-E17). Timestamps are UTC; every function is a composition of built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOOK_BEFORE = 21_600  # seconds searched before a synoptic time


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def synoptic_floor(ts: Column) -> Column:
    """The last of 00, 06, 12 and 18 h."""
    return F.date_trunc("day", ts) + F.make_interval(hours=F.floor(F.hour(ts) / 6).cast("int") * 6)


def synoptic_next(ts: Column, literal: bool = True) -> Column:
    """The next synoptic hour. As stated, hours from 18 on give 00 of the same day; ``literal=False`` gives that of the next day."""
    step = F.floor(F.hour(ts) / 6).cast("int") * 6 + 6
    return F.date_trunc("day", ts) + F.make_interval(hours=step % 24 if literal else step)


def look_around(delta_hours: Column) -> Column:
    """Seconds before and after for a delay of 0 to 5 hours; null beyond."""
    return F.when(delta_hours.between(0, 5), F.struct(F.lit(LOOK_BEFORE).alias("before"), (delta_hours * 3600).cast("int").alias("after")))


def job_times(end: Column) -> Column:
    """Of a job's end its hour, that hour's synoptic time, and the seconds to search around it."""
    hour = floor_hour(end)
    return F.struct(hour.alias("init"), synoptic_floor(hour).alias("synoptic"), look_around(F.hour(hour) % 6).alias("search"))


def job_coverage(run: Column, back_seconds: int) -> Column:
    """The hours covered by a run: to its hour, from ``back_seconds`` before."""
    end = floor_hour(run)
    return F.struct((end - F.make_interval(secs=F.lit(back_seconds))).alias("start"), end.alias("end"))


def day_of_year(year: Column, day: Column) -> Column:
    """E5: the date of a day of a year; an error when the year is negative or has no such day."""
    last = F.datediff(F.make_date(year, F.lit(12), F.lit(31)), F.make_date(year, F.lit(1), F.lit(1))) + 1
    wrong = F.when(year < 0, F.raise_error(F.format_string("year %d is negative", year))).when((day < 1) | (day > last), F.raise_error(F.format_string("year %d has no day %d", year, day)))
    return F.coalesce(wrong.cast("date"), F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (day - 1).cast("int")))


def timestamp_60(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """A timestamp whose second may be 60: the next minute."""
    return F.make_timestamp(year, month, day, hour, minute, F.lit(0)) + F.make_interval(secs=second)


def hms(seconds: Column) -> Column:
    """Hours, minutes, seconds."""
    s = seconds.cast("long")
    return F.struct(F.floor(s / 3600).alias("h"), F.floor(s % 3600 / 60).alias("m"), (s % 60).alias("s"))


def intervals(start: Column, end: Column, step: Column) -> Column:
    """Start, start + step, ... up to and with end; an error when start is after end."""
    return F.when(start > end, F.raise_error(F.lit("start is after end")).cast("array<timestamp>")).otherwise(F.sequence(start, end, step))


def field_range(start: Column, end: Column, pattern: str) -> Column:
    """All values of one date field, zero-padded, between two times; empty when the field wraps."""
    a, b = F.date_format(start, pattern), F.date_format(end, pattern)
    return F.when(a.cast("int") <= b.cast("int"), F.transform(F.sequence(a.cast("int"), b.cast("int")), lambda i: F.lpad(i.cast("string"), F.length(a), "0"))).otherwise(F.array().cast("array<string>"))


def parse_tenths(text: Column) -> Column:
    """15 digits with tenths of a second."""
    return F.to_timestamp(text, "yyyyMMddHHmmssS")


def parse_seconds(text: Column) -> Column:
    """14 or 15 digits, tenths dropped."""
    return F.to_timestamp(F.substring(text, 1, 14), "yyyyMMddHHmmss")


def parse_day_of_year(text: Column) -> Column:
    """Year, day of year and time, yyyyDDDHHmmss."""
    return F.to_timestamp(text, "yyyyDDDHHmmss")


def formatted(ts: Column, pattern: str = "yyyy-MM-dd'T'HH:mm:ss'Z'") -> Column:
    """E11, E13."""
    return F.date_format(ts, pattern)


def epoch_fields(seconds: Column) -> Column:
    """The six calendar fields of epoch seconds, in UTC."""
    ts = F.timestamp_seconds(seconds)
    return F.struct(*(f(ts).cast("int").alias(n) for n, f in (("years", F.year), ("months", F.month), ("days", F.day), ("hours", F.hour), ("minutes", F.minute), ("seconds", F.second))))


def shifted(year: Column, month: Column, day: Column, hour: Column, pattern: str, offset: Column, compat: bool = False) -> Column:
    """A formatted time moved by ``offset`` seconds. ``compat``: a negative offset moves forward, as an old rule had it."""
    ts = F.make_timestamp(year, month, day, hour, F.lit(0), F.lit(0))
    return F.date_format(ts + F.make_interval(secs=F.abs(offset) if compat else offset), pattern)


def pack_code(day: Column, hour: Column) -> Column:
    """X for 00 and 12 h, Y for 06 and 18 h; from noon on the day counts 50 more. An error for other hours."""
    letter = F.when(hour.isin(0, 12), F.lit("X")).when(hour.isin(6, 18), F.lit("Y")).otherwise(F.raise_error(F.lit("not a synoptic hour")).cast("string"))
    return F.struct(letter.alias("code"), (day + F.when(hour >= 12, 50).otherwise(0)).alias("day"))


def unpack_code(code: Column, day: Column) -> Column:
    """Day and hour of a pack code (the inverse of E15, defined for all days)."""
    hour = F.when(code == "X", 0).when(code == "Y", 6).otherwise(F.raise_error(F.lit("not a pack code")).cast("int"))
    return F.struct(F.when(day > 50, day - 50).otherwise(day).alias("day"), (hour + F.when(day > 50, 12).otherwise(0)).alias("hour"))
