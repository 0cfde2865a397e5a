"""Version flags, current rows and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.catalog.base import FEED_FLAGS, day_of, query, table
from varve.functions.hashing import row_hash
from varve.operators.filters import current
from varve.operators.versioning import (
    FLAGS,
    add_deleted_flag,
    add_version_flags,
    key_times,
    latest,
    newest_of,
    part_of,
    upsert_versions,
    with_key_times,
)
from varve.session import discard, fresh_dir, materialize, materialize_counted, staged, tidy
from varve.sources.folders import Folder
from varve.sources.store import CODEC


def hashed(df: DataFrame, content: list[str]) -> DataFrame:
    return df.withColumn("_row_hash", row_hash(df.select(*content)))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as row versions: key user, content kind, time the day."""
    events = table(spark, sf_dir, "events").withColumn("day", day_of())
    return hashed(events, ["user_id", "event_type"])


RESULT = ["event_id", "user_id", "event_type", *FLAGS]


@query(FEED_FLAGS)
def version_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1-L4: the flags of a change feed."""
    return add_version_flags(feed(spark, sf_dir), "user_id", ts="day").select(*RESULT)


@query(
    """SELECT event_id, coalesce(day = min(day) OVER k, FALSE) AS _initial,
              coalesce(day = max(day) OVER k, FALSE) AS _latest,
              coalesce(day <> min(day) OVER k AND day = min(day) OVER h, FALSE) AS _update
       FROM (SELECT event_id, event_type, CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE user_id END AS usr,
                    CASE WHEN value < 5 THEN NULL ELSE CAST(ts AS DATE) END AS day FROM events)
       WINDOW k AS (PARTITION BY usr), h AS (PARTITION BY concat_ws('|', event_type, usr))"""
)
def version_flags_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1-L4: a third of the rows has no key, some have no time."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.when(~F.col("event_type").isin("error", "view"), F.col("user_id")).alias("user_id"),
        F.when(F.col("value") >= 5, day_of()).alias("day"),
    )
    rows = hashed(events, ["user_id", "event_type"])
    return add_version_flags(rows, "user_id", ts="day").select("event_id", *FLAGS)


@query(f"SELECT event_id, user_id, event_type FROM ({FEED_FLAGS}) WHERE _latest")
def silver_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the current rows of a flagged table."""
    flagged = add_version_flags(feed(spark, sf_dir), "user_id", ts="day")
    return current(flagged).select("event_id", "user_id", "event_type")


@query(
    f"SELECT event_id, user_id, event_type FROM ({FEED_FLAGS}) WHERE _latest AND event_type <> 'error'"
)
def silver_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """current rows under the table's own predicate."""
    flagged = add_version_flags(feed(spark, sf_dir), "user_id", ts="day")
    return current(flagged, "event_type <> 'error'").select("event_id", "user_id", "event_type")


@query(f"SELECT event_id, user_id, event_type FROM ({FEED_FLAGS}) WHERE _latest")
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current rows of a table without flags."""
    events = table(spark, sf_dir, "events").withColumn("day", day_of())
    return latest(events, "user_id", "day").select("event_id", "user_id", "event_type")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
              l_linenumber = min(l_linenumber) OVER d AS _initial,
              l_linenumber = max(l_linenumber) OVER d AS _latest,
              l_linenumber <> min(l_linenumber) OVER d AND l_linenumber = min(l_linenumber) OVER
                (PARTITION BY l_shipdate, l_returnflag, l_linestatus) AS _update
       FROM lineitem WINDOW d AS (PARTITION BY l_shipdate)"""
)
def snapshot_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest snapshot of every business date."""
    rows = hashed(table(spark, sf_dir, "lineitem"), ["l_shipdate", "l_returnflag", "l_linestatus"])
    flagged = add_version_flags(rows, "l_shipdate", ts="l_linenumber")
    return flagged.select("l_orderkey", "l_linenumber", "l_partkey", *FLAGS)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, NOT bool_or(newest) OVER
                (PARTITION BY l_shipdate, l_returnflag, l_linestatus) AS _deleted
       FROM (SELECT *, l_linenumber = max(l_linenumber) OVER (PARTITION BY l_shipdate) AS newest FROM lineitem)"""
)
def deleted_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content that the newest snapshot of its date no longer has."""
    rows = hashed(table(spark, sf_dir, "lineitem"), ["l_shipdate", "l_returnflag", "l_linestatus"])
    rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "_row_hash")
    flagged = materialize(add_version_flags(rows, "l_shipdate", ts="l_linenumber"), "flagged")
    deleted = add_deleted_flag(flagged, "l_shipdate", ts="l_linenumber")
    return deleted.select("l_orderkey", "l_linenumber", "l_partkey", "_deleted")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, NOT bool_or(alive) OVER
                (PARTITION BY l_orderkey, l_returnflag, l_linestatus) AS _deleted
       FROM (SELECT *, l_linenumber = max(l_linenumber) OVER (PARTITION BY l_orderkey)
                         AND l_linenumber = max(l_linenumber) OVER (PARTITION BY l_shipdate) AS alive FROM lineitem)"""
)
def deleted_flag_other_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where versions go by another key than the date."""
    content = ["l_orderkey", "l_returnflag", "l_linestatus"]
    rows = table(spark, sf_dir, "lineitem").select(*content, "l_linenumber", "l_partkey", "l_shipdate")
    parts = max(1, min(MOST_PARTS, -(-rows.count() // PART_ROWS)))
    result = ["l_orderkey", "l_linenumber", "l_partkey", "_deleted"]
    return deleted_in_parts(rows, parts, content, "l_orderkey", "l_shipdate", "l_linenumber", result)


# Rows that are flagged at once, as far as parts go, and the most parts.
PART_ROWS, MOST_PARTS = 2_000_000, 16


def deleted_in_parts(
    rows: DataFrame, parts: int, content: list[str], key: str, date: str, ts: str, result: list[str]
) -> DataFrame:
    """Version flags by ``key`` and the deleted flag by ``date``, a part of the rows after the other.

    Parts go by the hash of the content, so that all rows of one content are in one; what holds for
    a key or a date is found over all rows before. The hash, which would be most of the bytes, is
    made anew from its columns instead of staged, taken as bytes instead of digits, and what a part
    has shuffled goes before the next.
    """
    if parts == 1:
        flagged = materialize(add_version_flags(hashed(rows, content), key, ts=ts), "flagged")
        return add_deleted_flag(flagged, date, ts=ts).select(*result)
    spark, done = rows.sparkSession, fresh_dir(rows.sparkSession, "deleted")
    with tidy(spark):
        path, times = fresh_dir(spark, "rows"), fresh_dir(spark, "times")
        by_key, keys = materialize_counted(key_times(rows, key, ts), "times", codec=CODEC, path=times)
        newest = materialize(newest_of(rows, date, ts), "newest")
        timed = with_key_times(rows, by_key, key, keys["rows"])
        cut = hashed(timed, content).withColumn("__part", part_of(parts)).drop("_row_hash")
        staged(cut, "rows", "__part", codec=CODEC, path=path)
        for name in Folder(spark, path).names():
            if not name.startswith("__part="):
                continue
            folder, flags = f"{path}/{name}", fresh_dir(spark, "flagged")
            some = hashed(spark.read.schema(timed.schema).parquet(folder), content)
            some = some.withColumn("_row_hash", F.unhex("_row_hash"))
            flagged = add_version_flags(some, key, ts=ts, timed=True)
            needed = {*result, date, ts, "_row_hash", *FLAGS}
            flagged, _ = staged(flagged.select([c for c in flagged.columns if c in needed]), "flagged", codec=CODEC, path=flags)
            deleted = add_deleted_flag(flagged, date, ts=ts, newest=newest).select(*result)
            deleted.write.mode("append").option("compression", CODEC).parquet(done)
            discard(spark, folder, flags)
        discard(spark, path, times)
    return spark.read.schema(deleted.schema).parquet(done)


@query(FEED_FLAGS)
def incremental_equals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change-only upsert of the later days into the earlier ones."""
    rows = feed(spark, sf_dir)
    early = add_version_flags(rows.where("day < DATE'2024-01-21'"), "user_id", ts="day")
    history = materialize(early, "history")
    new = materialize(rows.where("day >= DATE'2024-01-21'"), "new")
    return upsert_versions(history, new, "user_id", ts="day").select(*RESULT)
