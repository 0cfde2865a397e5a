"""Clocks, look-back windows and batch names."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import Column
from pyspark.sql import functions as F

from varve.spec import plain_name

# Days each kind of extract looks back.
LEAD_DAYS = 3
ASSET_DAYS = 30
BULK_DAYS = 1
WORKLIST_DAYS = 7


def utc(clock: datetime) -> datetime:
    """The injected clock; it must name its zone, so that no local time slips in."""
    if clock.tzinfo is None:
        raise ValueError("the clock must carry a time zone")
    return clock.astimezone(timezone.utc)


def clock_micros(clock: datetime) -> int:
    return (utc(clock) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def lookback(clock: datetime | date, days: int) -> Column:
    """The date ``days`` before the clock's (UTC) date."""
    day = utc(clock).date() if isinstance(clock, datetime) else clock
    return F.date_sub(F.lit(day), days)


def iso_utc(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:mm:ssZ`` text of a UTC time."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def batch_id(base: str, clock: datetime) -> str:
    """A unique batch name that sorts by time: base, UTC time, random part."""
    plain_name(base, "batch base name")
    return f"{base}_{utc(clock):%Y%m%dT%H%M%S}_{uuid4().hex}"


def batch_names(base: str | Column, ts: Column) -> Column:
    """Column form of :func:`batch_id` for many batches at once."""
    if isinstance(base, str):
        base = F.lit(plain_name(base, "batch base name"))
    return F.concat_ws(
        "_", base, F.date_format(ts, "yyyyMMdd'T'HHmmss"), F.replace(F.uuid(), F.lit("-"), F.lit(""))
    )
