"""Instants as columns. The session zone is UTC (see ``session.configure``)."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# A trailing zone offset, and the two ISO-8601 layouts in use.
OFFSET_PATTERN = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssxxx"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"

DAY_SECONDS = 86_400


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of an instant, or of a zone-less UTC reading."""
    return F.unix_timestamp(F.col(ts) if isinstance(ts, str) else ts)


def instant(epoch: Column | str) -> Column:
    return F.timestamp_seconds(epoch)


def has_offset(text: Column | str) -> Column:
    return F.coalesce(F.rlike(text, F.lit(OFFSET_PATTERN)), F.lit(False))


def utc_from_text(text: Column | str) -> Column:
    """Instant of an ISO-8601 text; null when it names no zone or is malformed."""
    return F.when(has_offset(text), F.try_to_timestamp(text))


def utc_from_zone(naive: Column | str, zone: str) -> Column:
    """Instant of a zone-less reading taken in ``zone``."""
    return F.to_utc_timestamp(naive, zone)


def batch_end(ts: Column | str) -> Column:
    """Midnight at the start of the day: the end of the last whole daily batch."""
    return F.date_trunc("day", ts)


def batch_label(end: Column | str) -> Column:
    """A batch carries the date of its exclusive end."""
    return F.to_date(end)


def hours(count: Column | int) -> Column:
    return F.make_dt_interval(F.lit(0), count if isinstance(count, Column) else F.lit(count))


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 with offset; the fraction is written only when there is one."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.when(
        F.unix_micros(column) % 1_000_000 == 0, F.date_format(column, ISO_SECONDS)
    ).otherwise(F.date_format(column, ISO_MICROS))


def require_aware(value: datetime, name: str) -> datetime:
    """The Python value in UTC; a zone-less one is an error."""
    if value.tzinfo is None or value.utcoffset() is None:
        raise ValueError(f"{name} must be timezone-aware.")
    return value.astimezone(UTC)


def epoch_of(value: datetime) -> int:
    """Smallest whole second not before ``value``, for half-open bounds on seconds."""
    since = require_aware(value, "value") - datetime(1970, 1, 1, tzinfo=UTC)
    return -((-since) // timedelta(seconds=1))
