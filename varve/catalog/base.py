"""Registry of queries and what several of them share."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.session import fresh_dir, ship
from varve.spec import TableSpec, Zones

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The injected clock of all registered queries: just after the last event.
CLOCK = datetime(2024, 2, 1, tzinfo=timezone.utc)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, under its function's name unless told, with its SQL if any."""

    def register(function: Query) -> Query:
        key = name or function.__name__

        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_zones(spark: SparkSession, source: str) -> Zones:
    return Zones(fresh_dir(spark, "zones"), source)


def day_of(ts: str = "ts") -> Column:
    return F.to_date(ts)


def micros_text(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# The change feed: one batch a day, keyed by user, its content the kind of event.
FEED = TableSpec("events", "user_id", schema="user_id BIGINT, event_type STRING, _event_id BIGINT")


def daily_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change-feed rows, with the name of their daily landing batch.

    The event id only identifies a row in the result; by its underscore it is no content.
    """
    return table(spark, sf_dir, "events").select(
        "user_id",
        "event_type",
        F.col("event_id").alias("_event_id"),
        F.date_format("ts", "'events_'yyyyMMdd").alias("name"),
    )


# Flags of the change feed, written with windows.
FEED_FLAGS = """
    SELECT event_id, user_id, event_type,
           day = min(day) OVER (PARTITION BY user_id) AS _initial,
           day = max(day) OVER (PARTITION BY user_id) AS _latest,
           day <> min(day) OVER (PARTITION BY user_id)
             AND day = min(day) OVER (PARTITION BY user_id, event_type) AS _update
    FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)
"""
