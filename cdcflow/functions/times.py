"""Epoch milliseconds and time formatting, independent of the session time zone for NTZ input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
MS_PER_HOUR = 3_600_000
MS_PER_MINUTE = 60_000


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP (an instant)."""
    return F.unix_millis(ts)


def _since_epoch(ts: Column) -> Column:
    # A difference of wall clocks: an interval, which no session time zone can change.
    return ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_ms_of_utc(ts: Column) -> Column:
    """Epoch milliseconds of a UTC wall clock (TIMESTAMP_NTZ), fractions of a millisecond cut."""
    seconds = _since_epoch(ts).cast("interval second").cast("decimal(20,6)")
    return F.floor(seconds * 1000).cast("bigint")


def epoch_ms_by_fields(ts: Column) -> Column:
    """Epoch milliseconds of a UTC wall clock, added up from days, hours, minutes and rounded seconds."""
    since = _since_epoch(ts)

    def part(name: str) -> Column:
        return F.extract(F.lit(name), since)

    return (
        part("DAY").cast("bigint") * MS_PER_DAY
        + part("HOUR").cast("bigint") * MS_PER_HOUR
        + part("MINUTE").cast("bigint") * MS_PER_MINUTE
        + F.round(part("SECOND") * 1000).cast("bigint")
    )


def utc_now() -> Column:
    """The current instant in epoch milliseconds; one value per query."""
    return F.unix_millis(F.current_timestamp())


def stamp_suffix(ts: Column) -> Column:
    """``HHmmss-SSS`` of a wall clock, the suffix of a fresh test key."""
    return F.date_format(ts, "HHmmss-SSS")
