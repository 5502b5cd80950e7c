"""Timestamps to text and back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of stored and produced timestamp text.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
ISO_SECONDS_OFFSET = "yyyy-MM-dd'T'HH:mm:ssxxx"
ISO_MICROS_OFFSET = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def iso_millis(ts: Column | str) -> Column:
    """ISO text with milliseconds and offset; microseconds are cut, UTC prints ``Z``."""
    return F.date_format(ts, ISO_MILLIS)


def iso_micros(ts: Column) -> Column:
    """ISO text with microseconds and offset; a whole second carries no fraction."""
    whole = F.date_trunc("second", ts) == ts
    return F.when(whole, F.date_format(ts, ISO_SECONDS_OFFSET)).otherwise(F.date_format(ts, ISO_MICROS_OFFSET))


def stored_time(ts: Column | str) -> Column:
    """The instant a node or edge keeps: millisecond precision, as its ISO text has."""
    return F.date_trunc("millisecond", ts)


def event_time(text: Column | str) -> Column:
    return F.try_to_timestamp(text)


def event_date(text: Column | str) -> Column:
    return F.to_date(text)


def as_utc(instant: datetime) -> datetime:
    """A zoned instant; without a zone the value is taken as UTC, never as the machine's zone."""
    if instant.tzinfo is None:
        return instant.replace(tzinfo=timezone.utc)
    return instant.astimezone(timezone.utc)
