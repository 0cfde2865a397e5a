"""Landing files as a stream."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.catalog.base import CLOCK, FEED, FEED_FLAGS, daily_feed, fresh_zones, query, table
from varve.catalog.jobs import BUCKETS
from varve.catalog.landing import EVENTS, EVENTS_SQL, event_rows
from varve.operators.versioning import FLAGS
from varve.sources.files import land_batches
from varve.sources.store import Store
from varve.streaming.landing import append_once, ingest_stream, run_available, stream_landing


@query(EVENTS_SQL)
def stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files read once each over two runs of a stream."""
    zones = fresh_zones(spark, "stream")
    events = table(spark, sf_dir, "events")
    early, out = F.col("ts") < "2024-01-16", f"{zones.control}/rows"
    for part in (events.where(early), events.where(~early)):
        named = part.withColumn("name", F.date_format("ts", "'events_'yyyyMMdd"))
        land_batches(named, zones, "events", "name")
        stream = stream_landing(spark, f"{zones.landing}/events", EVENTS)
        run_available(stream, f"{zones.control}/checkpoint", append_once(out))
    return event_rows(spark.read.schema(EVENTS).parquet(f"{out}/*"))


@query(FEED_FLAGS)
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze kept up to date by a stream; equal to loads by batch."""
    zones, feed = fresh_zones(spark, "stream"), daily_feed(spark, sf_dir)
    store = Store(spark, zones, buckets=BUCKETS)
    for days in ("name < 'events_20240116'", "name >= 'events_20240116'"):
        part = feed.where(days)
        land_batches(part, zones, "events", "name")
        ingest_stream(spark, zones, FEED, lambda epoch: CLOCK + timedelta(days=epoch), store=store)
    return store.read("events").select(
        F.col("_event_id").alias("event_id"), "user_id", "event_type", *FLAGS
    )
