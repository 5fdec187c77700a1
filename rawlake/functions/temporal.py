"""Date and time parts, formatting, zones, rounding and differences."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.functions.registry import function
from rawlake.functions.timeformat import FORMAT_CODES, to_spark_pattern

# Microseconds per unit.
UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
UNIT_MONTHS = {"month": 1, "quarter": 3, "year": 12}
DAY = UNIT_MICROS["day"]


def micros(value: Column) -> Column:
    """Microseconds since the epoch; wall-clock times count as UTC."""
    return F.unix_micros(value.cast("timestamp"))


def from_micros(number: Column, dtype: T.DataType) -> Column:
    instant = F.timestamp_micros(number)
    return instant if isinstance(dtype, T.TimestampType) else instant.cast("timestamp_ntz").cast(dtype)


def floor_div(number: Column, step: int | Column) -> Column:
    step = F.lit(step).cast("bigint")
    return F.call_function("div", number - F.pmod(number, step), step)


for _name, _fn in {
    "year": F.year, "quarter": F.quarter, "month": F.month, "day": F.dayofmonth, "hour": F.hour,
    "minute": F.minute, "day_of_year": F.dayofyear, "iso_week": F.weekofyear,
}.items():
    function(_name)(lambda value, dtype, fn=_fn: fn(value).cast("bigint"))

function("second")(lambda value, dtype: F.pmod(floor_div(micros(value), 1_000_000), F.lit(60)))
function("millisecond")(lambda value, dtype: F.pmod(floor_div(micros(value), 1_000), F.lit(1_000)))
function("microsecond")(lambda value, dtype: F.pmod(micros(value), F.lit(1_000)))
function("nanosecond")(lambda value, dtype: F.when(value.isNotNull(), F.lit(0).cast("bigint")))
function("subsecond")(lambda value, dtype: F.pmod(micros(value), F.lit(1_000_000)) / F.lit(1e6))


@function("day_of_week")
def day_of_week(value: Column, dtype: T.DataType, count_from_zero: bool = True, week_start: int = 1) -> Column:
    """``week_start`` is 1 for Monday to 7 for Sunday."""
    at = F.pmod(F.weekday(value) + F.lit(8 - week_start), F.lit(7))
    return (at if count_from_zero else at + 1).cast("bigint")


# -- weeks ---------------------------------------------------------------------------


def _week_anchor(value: Column, monday: bool, fully: bool = False) -> Column:
    """The day of the week that decides which year the week belongs to."""
    day = value.cast("date")
    into = F.weekday(day) if monday else F.pmod(F.weekday(day) + 1, F.lit(7))
    return F.date_add(F.date_sub(day, into), 0 if fully else 3)


def _week_number(anchor: Column) -> Column:
    return (floor_div(F.dayofyear(anchor).cast("bigint") - 1, 7) + 1).cast("bigint")


@function("week")
def week(
    value: Column,
    dtype: T.DataType,
    week_starts_monday: bool = True,
    count_from_zero: bool = False,
    first_week_is_fully_in_year: bool = False,
) -> Column:
    anchor = _week_anchor(value, week_starts_monday, first_week_is_fully_in_year)
    if not count_from_zero:
        return _week_number(anchor)
    # Counted within the date's own year: 0 before its first week.
    shift = F.year(anchor) - F.year(value)
    days = F.datediff(anchor, F.make_date(F.year(value), F.lit(1), F.lit(1)))
    return F.when(shift < 0, F.lit(0)).otherwise(floor_div(days.cast("bigint"), 7) + 1).cast("bigint")


function("us_week")(lambda value, dtype: _week_number(_week_anchor(value, False)))
function("us_year")(lambda value, dtype: F.year(_week_anchor(value, False)).cast("bigint"))
function("iso_year")(lambda value, dtype: F.year(_week_anchor(value, True)).cast("bigint"))


@function("iso_calendar")
def iso_calendar(value: Column, dtype: T.DataType) -> Column:
    anchor = _week_anchor(value, True)
    parts = F.struct(
        F.year(anchor).cast("bigint").alias("iso_year"),
        _week_number(anchor).alias("iso_week"),
        (F.weekday(value) + 1).cast("bigint").alias("iso_day_of_week"),
    )
    return F.when(value.isNotNull(), parts)


@function("year_month_day")
def year_month_day(value: Column, dtype: T.DataType) -> Column:
    parts = F.struct(
        F.year(value).cast("bigint").alias("year"),
        F.month(value).cast("bigint").alias("month"),
        F.dayofmonth(value).cast("bigint").alias("day"),
    )
    return F.when(value.isNotNull(), parts)


@function("is_leap_year")
def is_leap_year(value: Column, dtype: T.DataType) -> Column:
    year = F.year(value)
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


# -- text and zones --------------------------------------------------------------------


@function("strftime")
def strftime(value: Column, dtype: T.DataType, format: str = "%Y-%m-%dT%H:%M:%S", locale: str = "C") -> Column:
    if locale not in ("C", "en_US"):
        raise ValueError(f"Locale '{locale}' is not supported")
    codes = dict(FORMAT_CODES)
    if isinstance(dtype, T.DateType):
        codes |= {"S": "ss", "T": "HH:mm:ss"}
    return F.date_format(value, to_spark_pattern(format, codes))


@function("strptime")
def strptime(value: Column, dtype: T.DataType, format: str, unit: str = "us", error_is_null: bool = False) -> Column:
    pattern = F.lit(to_spark_pattern(format))
    parsed = F.try_to_timestamp(value, pattern).cast("timestamp_ntz")
    if error_is_null:
        return parsed
    bad = F.raise_error(F.concat(F.lit("strptime: cannot read "), value)).cast("timestamp_ntz")
    return F.when(value.isNull(), None).otherwise(F.coalesce(parsed, bad))


def _wall(instant: Column, tz: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), instant.cast("timestamp_ntz"))


@function("assume_timezone")
def assume_timezone(
    value: Column, dtype: T.DataType, timezone: str, ambiguous: str = "raise", nonexistent: str = "raise"
) -> Column:
    """Instant of a wall-clock time in a zone."""
    instant = F.convert_timezone(F.lit(timezone), F.lit("UTC"), value).cast("timestamp")
    hour = F.expr("interval 1 hour")
    before, after = instant - hour, instant + hour
    twice_before = _wall(before, timezone) == value
    twice_after = _wall(after, timezone) == value
    missing = _wall(instant, timezone) != value

    def bad(kind: str) -> Column:
        text = F.concat(F.lit(f"{kind} time in zone '{timezone}': "), value.cast("string"))
        return F.raise_error(text).cast("timestamp")

    picks = {
        "raise": bad("Ambiguous"),
        "earliest": F.when(twice_before, before).otherwise(instant),
        "latest": F.when(twice_after, after).otherwise(instant),
    }
    # A skipped wall-clock time lands after the jump; the jump itself is where
    # the shifted hour began.
    jump = F.date_trunc("hour", instant)
    gaps = {"raise": bad("Nonexistent"), "earliest": jump - F.expr("interval 1 microsecond"), "latest": jump}
    return F.when(missing, gaps[nonexistent]).when(twice_before | twice_after, picks[ambiguous]).otherwise(instant)


@function("local_timestamp")
def local_timestamp(value: Column, dtype: T.DataType, timezone: str = "UTC") -> Column:
    """Wall-clock time of an instant; Spark keeps no zone with it, so name it."""
    return value if isinstance(dtype, T.TimestampNTZType) else _wall(value, timezone)


@function("is_dst")
def is_dst(value: Column, dtype: T.DataType, timezone: str = "UTC") -> Column:
    """Whether the zone's offset at this instant exceeds its smaller one of the
    year (January against July)."""

    def offset(instant: Column) -> Column:
        return micros(_wall(instant, timezone)) - micros(instant.cast("timestamp_ntz"))

    year = F.year(_wall(value, timezone))
    winter = offset(F.make_timestamp_ntz(year, F.lit(1), F.lit(1), F.lit(12), F.lit(0), F.lit(0)).cast("timestamp"))
    summer = offset(F.make_timestamp_ntz(year, F.lit(7), F.lit(1), F.lit(12), F.lit(0), F.lit(0)).cast("timestamp"))
    return offset(value) > F.least(winter, summer)


# -- rounding ------------------------------------------------------------------------------


def _month_index(value: Column) -> Column:
    return ((F.year(value) - 1970) * 12 + F.month(value) - 1).cast("bigint")


def _month_micros(index: Column) -> Column:
    """Start of a month counted from January 1970."""
    year = floor_div(index, 12) + 1970
    month = F.pmod(index, F.lit(12)) + 1
    return F.unix_date(F.make_date(year.cast("int"), month.cast("int"), F.lit(1))).cast("bigint") * DAY


_PARENT = {
    "microsecond": "millisecond", "millisecond": "second", "second": "minute", "minute": "hour",
    "hour": "day", "day": "month", "month": "year", "quarter": "year",
}


def _bounds(
    value: Column, multiple: int, unit: str, monday: bool, calendar_origin: bool
) -> tuple[Column, Column]:
    """Start of the interval ``value`` lies in, and of the next one."""
    if unit == "nanosecond":
        if multiple % 1000:
            raise ValueError("Spark's timestamps have no nanoseconds")
        unit, multiple = "microsecond", multiple // 1000
    number = micros(value)
    if unit in UNIT_MONTHS:
        step = multiple * UNIT_MONTHS[unit]
        index = _month_index(value)
        if unit == "year":
            origin = F.lit(-1970 * 12).cast("bigint")
        elif calendar_origin:
            origin = index - F.pmod(index, F.lit(12))
        else:
            origin = F.lit(0).cast("bigint")
        low = index - F.pmod(index - origin, F.lit(step).cast("bigint"))
        return _month_micros(low), _month_micros(low + step)
    step = F.lit(multiple * UNIT_MICROS[unit]).cast("bigint")
    if unit == "week":
        if calendar_origin:
            raise ValueError("calendar_based_origin is not defined for weeks here")
        origin = F.lit((-3 if monday else -4) * DAY).cast("bigint")
    elif calendar_origin:
        origin = _bounds(value, 1, _PARENT[unit], monday, False)[0]
    else:
        origin = F.lit(0).cast("bigint")
    low = number - F.pmod(number - origin, step)
    return low, low + step


def _rounded(how: str):
    def builder(
        value: Column,
        dtype: T.DataType,
        multiple: int = 1,
        unit: str = "day",
        week_starts_monday: bool = True,
        ceil_is_strictly_greater: bool = False,
        calendar_based_origin: bool = False,
    ) -> Column:
        number = micros(value)
        low, high = _bounds(value, multiple, unit, week_starts_monday, calendar_based_origin)
        if how == "floor":
            result = low
        elif how == "ceil":
            # Calendar units always move on to the next start.
            strict = ceil_is_strictly_greater or unit in UNIT_MONTHS
            result = high if strict else F.when(number == low, low).otherwise(high)
        else:
            result = F.when(number - low >= high - number, high).otherwise(low)
        return from_micros(result, dtype)

    return builder


for _how in ("floor", "ceil", "round"):
    function(f"{_how}_temporal")(_rounded(_how))


# -- differences -----------------------------------------------------------------------------


def _other(value: Any) -> Column:
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    return F.lit(value)


def _between(of):
    """How many unit boundaries lie between, from the column to the operand."""
    return lambda value, dtype, other: (of(_other(other)) - of(value)).cast("bigint")


function("years_between")(_between(lambda v: F.year(v)))
function("quarters_between")(_between(lambda v: F.year(v) * 4 + F.quarter(v)))
for _unit in ("day", "hour", "minute", "second", "millisecond", "microsecond"):
    function(f"{_unit}s_between")(_between(lambda v, u=_unit: floor_div(micros(v), UNIT_MICROS[u])))
function("nanoseconds_between")(_between(lambda v: micros(v) * 1000))


@function("weeks_between")
def weeks_between(
    value: Column, dtype: T.DataType, other: Any, count_from_zero: bool = True, week_start: int = 1
) -> Column:
    def number(v: Column) -> Column:
        # 1970-01-01 was a Thursday.
        return floor_div(F.unix_date(v.cast("date")).cast("bigint") + 3 - (week_start - 1), 7)

    return number(_other(other)) - number(value)
