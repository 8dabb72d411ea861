"""hhmm clock values to instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hhmm_timestamp(year: Column, month: Column, day: Column, hhmm: Column) -> Column:
    """Local wall-clock instant of an hhmm value on a date.

    Whole-minute arithmetic (``hhmm % 100``), so no minute is lost; 2400 is
    midnight of the next day. Invalid parts give NULL, never an error.
    """
    date = F.try_make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0))
    hours = F.floor(hhmm / 100).cast("int")
    minutes = (hhmm % 100).cast("int")
    valid = (hours >= 0) & (hours <= 24) & (minutes >= 0) & (minutes < 60) & \
        ~((hours == 24) & (minutes > 0))
    offset = F.make_dt_interval(F.lit(0), hours, minutes)
    return F.when(valid, date + offset)


def local_to_utc(local_ts: Column, zone: Column) -> Column:
    """Wall clock in ``zone`` -> UTC wall clock (both timestamp_ntz, so the
    session time zone plays no part). NULL zone -> NULL."""
    return F.convert_timezone(zone, F.lit("UTC"), local_ts)


def add_minutes(ts: Column, minutes: Column) -> Column:
    """Instant plus whole minutes (the fractional part is dropped)."""
    mins = F.floor(minutes).cast("int")
    return F.try_add(ts, F.make_dt_interval(F.lit(0), F.lit(0), mins))


def utc_instant(wall_clock_utc: Column) -> Column:
    """A UTC wall clock (timestamp_ntz, whole seconds) as a TIMESTAMP instant,
    whatever the session time zone is (for watermarks, which need TIMESTAMP)."""
    c = wall_clock_utc
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.second(c).cast("decimal(16,6)"), F.lit("UTC"))


def utc_wall_clock(instant: Column, session_zone: str) -> Column:
    """A TIMESTAMP instant as its UTC wall clock (timestamp_ntz)."""
    return F.convert_timezone(F.lit(session_zone), F.lit("UTC"), instant.cast("timestamp_ntz"))
