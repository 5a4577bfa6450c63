"""Epoch arithmetic on wall-clock (``timestamp_ntz``) columns, whatever the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Seconds from year 1 to year 9999.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def from_epoch(seconds: Column) -> Column:
    """UTC wall-clock time of an epoch; NULL outside the years 1 to 9999."""
    seconds = F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds)
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def epoch_seconds(timestamp: Column) -> Column:
    """Whole seconds since the epoch, the fraction cut off."""
    days = F.unix_date(timestamp.cast("date")).cast("bigint")
    return days * 86400 + F.hour(timestamp) * 3600 + F.minute(timestamp) * 60 + F.second(timestamp)


def seconds_between(start: Column, end: Column) -> Column:
    """Difference of two instants, each cut to the second."""
    return epoch_seconds(end) - epoch_seconds(start)
