"""The shared working folder and the helpers that write to it."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from threading import Lock
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows a table may have, by count, to be sent whole to every executor.
BROADCAST_ROWS = 100_000


@cache
def _test_folder() -> str:
    return tempfile.mkdtemp(prefix="varve-")


def work_dir(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir`` of the session.

    A temporary folder stands in only for a local-mode session that names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _test_folder()


@cache
def _archive() -> str:
    home = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="varve-code-"), "varve")
    return shutil.make_archive(target, "zip", os.path.dirname(home), os.path.basename(home))


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per session.

    Needed where workers do not have it installed and run its functions, such as paged
    sources and keyed fetches.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        context.addPyFile(_archive())
        _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid4().hex}"


def staged(
    df: DataFrame, name: str, *parted: str, codec: str | None = None, path: str | None = None
) -> tuple[DataFrame, str]:
    """Write ``df`` once, in folders by the columns ``parted``; the table read back, and its folder."""
    spark = df.sparkSession
    path = path or fresh_dir(spark, name)
    (df.write.option("compression", codec) if codec else df.write).partitionBy(*parted).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete staged folders that no later step reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


# Spark's setting by which a query's shuffle files go when it ends; else they stay until the driver
# happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Of each session, how many are inside, and the value the setting had before.
_TIDY: dict[int, list] = {}
_TIDY_LOCK = Lock()


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries that begin inside delete their shuffle files when they end, whichever thread runs them.

    For writes of frames that are run once; one that is run again shuffles again.
    """
    with _TIDY_LOCK:
        held = _TIDY.setdefault(id(spark), [0, spark.conf.get(CLEANUP)])
        held[0] += 1
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _TIDY_LOCK:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(CLEANUP, _TIDY.pop(id(spark))[1])


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and read it back, so that its lineage ends at durable files."""
    return staged(df, name)[0]


def materialize_counted(
    df: DataFrame,
    name: str,
    *parted: str,
    codec: str | None = None,
    path: str | None = None,
    **counts: Column,
) -> tuple[DataFrame, dict]:
    """:func:`materialize`, with aggregates that the write itself takes, ``rows`` always."""
    counted = Observation()
    named = [F.count("*").alias("rows"), *[c.alias(n) for n, c in counts.items()]]
    written, _ = staged(df.observe(counted, *named), name, *parted, codec=codec, path=path)
    return written, counted.get


def written_report(df: DataFrame, name: str) -> tuple[str, int]:
    """Write a report of any length for who reads an error; its path and number of rows."""
    path, counted = fresh_dir(df.sparkSession, name), Observation()
    df.observe(counted, F.count("*").alias("rows")).write.parquet(path)
    return path, counted.get["rows"]


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the counted rows are within ``limit``, else leave it to AQE."""
    return F.broadcast(df) if rows <= limit else df
