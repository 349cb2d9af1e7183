"""Dates and clock times as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_MONTH = 30.436875  # fixed value: mean Gregorian month in days


def _since_epoch(ts: Column) -> Column:
    """Clock seconds since 1970 with microseconds; no time-zone shift, whatever the session zone is."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return (ts.cast("timestamp_ntz") - epoch).cast("interval second").cast("decimal(18,6)")


def seconds_of(ts: Column) -> Column:
    """Clock seconds since 1970 as a double."""
    return _since_epoch(ts).cast("double")


def micros_of(ts: Column) -> Column:
    """Clock microseconds since 1970."""
    return (_since_epoch(ts) * 1_000_000).cast("long")


def months_between_instants(start: Column, end: Column) -> Column:
    """Elapsed mean months, at least 1."""
    return F.greatest((seconds_of(end) - seconds_of(start)) / (86400 * DAYS_PER_MONTH), F.lit(1.0))


def hhmm_to_minutes(column: Column) -> Column:
    return F.substring(column, 1, 2).cast("int") * 60 + F.substring(column, 3, 2).cast("int")


def hhmm_to_hour(column: Column) -> Column:
    return F.substring(column, 1, 2)


def month_trunc(ts: Column) -> Column:
    return F.date_trunc("month", ts)
