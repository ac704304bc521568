"""Zone-free date arithmetic on ``timestamp_ntz``.

Nothing here passes through a zoned timestamp, so a session time zone with
daylight saving neither drops nor repeats a step of a grid.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def seconds_of(time: Column) -> Column:
    """Whole seconds since 1970-01-01 of a local time."""
    gap = time.cast("timestamp_ntz") - F.expr(EPOCH)
    return gap.cast("interval second").cast("bigint")


def tick_of(time: Column, step_seconds: int) -> Column:
    """Index of the grid step that contains ``time``."""
    seconds = seconds_of(time)
    if step_seconds == 1:
        return seconds
    return F.call_function("div", seconds - F.pmod(seconds, F.lit(step_seconds)), F.lit(step_seconds))


def time_of(tick: Column, step_seconds: int) -> Column:
    """Local time at which grid step ``tick`` starts."""
    zero = F.lit(0)
    return F.expr(EPOCH) + F.make_dt_interval(zero, zero, zero, tick * F.lit(step_seconds))


def moment(value: datetime) -> Column:
    """A Python local time as a literal without a zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def on_grid(time: Column, step_seconds: int) -> Column:
    return time == time_of(tick_of(time, step_seconds), step_seconds)


def shift_time(time: Column, seconds: int = 0, minutes: int = 0, hours: int = 0, days: int = 0) -> Column:
    return time + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(seconds))


def start_of_day(time: Column) -> Column:
    return time.cast("date").cast("timestamp_ntz")


def date_text(time: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(time, pattern)


def parse_ymd(text: Column) -> Column:
    """``yyyyMMdd`` as a date; impossible days are null."""
    dashed = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(text.rlike("^[0-9]{8}$"), dashed.try_cast("date"))


def day_hour(ymd: Column, hour: Column) -> Column:
    """``yyyyMMdd`` text and a whole hour 0..23 as local time; else null."""
    zero = F.lit(0)
    start = parse_ymd(ymd).cast("timestamp_ntz")
    return F.when(hour.between(0, 23), start + F.make_dt_interval(zero, hour, zero, zero))


def parse_compact_hour(text: Column) -> Column:
    """``yyyyMMddHH`` as local time; impossible values are null."""
    return F.when(
        text.rlike("^[0-9]{10}$"),
        day_hour(F.substring(text, 1, 8), F.substring(text, 9, 2).cast("int")))


def parse_time(text: Column) -> Column:
    """Free-form local time: ISO, ``/`` or ``.`` separated, or compact; else null."""
    trimmed = F.trim(text.cast("string"))
    dashed = F.regexp_replace(trimmed, r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})", "$1-$2-$3")
    compact = F.regexp_replace(
        trimmed, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})?$", "$1-$2-$3 $4:00:00")
    # A cast alone would also take words such as "today".
    return F.when(trimmed.rlike(r"^\d{4}"), F.coalesce(
        dashed.try_cast("timestamp_ntz"), compact.try_cast("timestamp_ntz")))


def day_series(first: Column, last: Column) -> Column:
    """Array of all dates from ``first`` to ``last``, both included."""
    return F.sequence(first.cast("date"), last.cast("date"), F.expr("interval 1 day"))


def is_weekend(time: Column) -> Column:
    return (F.weekday(time) >= 5).cast("int")
