"""Time-zone and truncation expressions on `timestamp_ntz` (UTC wall clock in, no session zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_time(utc: Column, zone: str) -> Column:
    """UTC wall clock to local wall clock."""
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_to_utc(local: Column, zone: str) -> Column:
    return local if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def floor_minutes(ts: Column, minutes: int) -> Column:
    """Start of the `minutes`-wide bucket within the hour; 60 gives the hour itself."""
    slot = F.lit(0) if minutes == 60 else F.floor(F.minute(ts) / minutes).cast("int") * minutes
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.day(ts), F.hour(ts), slot, F.lit(0)
    )


def day_start(ts: Column) -> Column:
    """Midnight of the same wall-clock day."""
    return ts.cast("date").cast("timestamp_ntz")


def delivery_midnight_utc(utc: Column, zone: str) -> Column:
    """UTC instant of the local midnight that opens the delivery day of `utc`."""
    return local_to_utc(day_start(local_time(utc, zone)), zone)


def epoch_seconds(ts: Column) -> Column:
    """Seconds from 1970-01-01 of an NTZ value, in double so sub-second offsets stay visible."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", origin, ts) / F.lit(1e6)


def instant_to_utc(instant: Column) -> Column:
    """UTC wall clock of an instant, reckoned from its epoch so that no session wall clock is involved."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(8,0)")
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return origin + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def parse_to_utc(value: Column) -> Column:
    """Parse text to UTC wall clock, whatever offset the text carries.

    Text without an offset counts as UTC: it is read with an explicit offset appended, so the
    session zone has no say.
    """
    text = F.trim(value.cast("string"))
    stamped = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return instant_to_utc(F.to_timestamp(stamped))


def day_number(day: Column) -> Column:
    """Days since 1970-01-01, for RANGE frames and date arithmetic."""
    return F.unix_date(day)
