"""Clocks: parsing, local time and UTC, epoch nanoseconds, calendar parts, Easter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isochron.fixed_values import LOCAL_ZONE


def parse_local(date: Column, hour: Column, fmt: str = "yyyy-MM-dd HH:mm") -> Column:
    """Date and hour texts as a wall-clock timestamp; null if either is missing or unreadable."""
    joined = F.when(date.isNotNull() & hour.isNotNull(), F.concat_ws(" ", date, hour))
    return F.try_to_timestamp(joined, F.lit(fmt))


def parse_local_day_first(date: Column, hour: Column) -> Column:
    """The same for day-first dates written with '.' or '/'."""
    return parse_local(F.translate(date, ".", "/"), hour, "d/M/yyyy H:mm")


def local_to_utc(wall: Column, zone: str = LOCAL_ZONE, overlap: str = "earliest") -> Column:
    """Wall-clock time to UTC.

    A time inside the spring gap moves forward to the end of the gap. A time inside the autumn overlap
    is ambiguous: overlap = 'earliest', 'latest' or 'null' says what becomes of it.
    """
    utc = F.to_utc_timestamp(wall, zone)
    hour = F.expr("interval 1 hour")
    in_gap = F.from_utc_timestamp(utc, zone) != wall
    repeats = F.from_utc_timestamp(utc + hour, zone) == wall
    shifted = F.date_trunc("hour", utc)
    choice = {"earliest": utc, "latest": utc + hour, "null": F.lit(None).cast("timestamp")}[overlap]
    return F.when(in_gap, shifted).when(repeats, choice).otherwise(utc)


def utc_to_local(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(instant, zone)


def epoch_ns_to_timestamp(nanoseconds: Column) -> Column:
    """Exact to the microsecond; integer division, as doubles cannot hold today's nanosecond counts."""
    return F.timestamp_micros(F.call_function("div", nanoseconds, F.lit(1000)))


def hour_of(instant: Column) -> Column:
    return F.date_trunc("hour", instant)


def plus_hours(instant: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours.cast("int"), instant)


def is_weekend(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0)


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Calendar parts of a local timestamp. dow counts from Sunday = 1; weeks are ISO weeks."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "dow": F.dayofweek(ts),
        "doy": F.dayofyear(ts),
        "week": F.weekofyear(ts),
        "quarter": F.quarter(ts),
        "is_weekend": is_weekend(ts),
    }


def dow_from_monday(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts)


def dow_iso(ts: Column) -> Column:
    """Monday = 1."""
    return F.weekday(ts) + 1


def easter(year: Column) -> Column:
    """Easter Sunday by Lichtenberg's form of Gauss's rule, counted as days after the last of February."""
    def whole(top: Column, bottom: int) -> Column:
        return F.floor(top / bottom).cast("int")

    century = whole(year, 100)
    moon_shift = 15 + whole(3 * century + 3, 4) - whole(8 * century + 13, 25)
    sun_shift = 2 - whole(3 * century + 3, 4)
    lunar_year = year % 19
    seed = (19 * lunar_year + moon_shift) % 30
    full_moon = 21 + seed - whole(seed + whole(lunar_year, 11), 29)
    first_sunday = 7 - F.pmod(year + whole(year, 4) + sun_shift, F.lit(7))
    march_day = full_moon + 7 - F.pmod(full_moon - first_sunday, F.lit(7))
    return F.date_add(F.make_date(year, F.lit(3), F.lit(1)), (march_day - 1).cast("int"))
