"""Metadata columns of a row version (M4-M8)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.functions.columns import column
from varve.functions.hashing import row_hash
from varve.functions.times import clock_micros
from varve.session import broadcast_if_small

SOURCE = "_raw_file_source"

# A landing batch is a file, or a folder of part files that Spark wrote as one. A folder
# may carry the name as a partition value ("batch=<name>").
BATCH_NAME = r"(?:batch=)?([^/=]+\.(?:jsonl|csv))"
BATCH_PATTERN = BATCH_NAME + r"(?:/[^/]+)?$"


def batch_of(path: Column) -> Column:
    """Name of the landing batch a file path belongs to.

    Says the same as ``BATCH_PATTERN``, without a regular expression per row.
    """
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    in_folder = folder.endswith(".jsonl") | folder.endswith(".csv")
    name = F.when(in_folder, folder).otherwise(F.substring_index(path, "/", -1))
    return F.when(name.startswith("batch="), F.substring(name, 7, 1 << 30)).otherwise(name)


def source_file(df: DataFrame, override: str | None = None) -> Column:
    """The row's source file (M7): an override, a column captured earlier, or the scan's."""
    if override is not None:
        return F.lit(override)
    if SOURCE in df.columns:
        return F.col(SOURCE)
    return F.col("_metadata.file_path")


def add_basic_metadata(
    df: DataFrame,
    clock: datetime,
    code_version: str | None = None,
    source: str | None = None,
    hash_mode: str = "compat",
) -> DataFrame:
    """Add row hash, insert and update time, code version and source file (M1, M5-M8).

    Columns with a leading underscore never enter the hash. The update time starts as the
    insert time and is reserved.
    """
    now = F.timestamp_micros(F.lit(clock_micros(clock)))
    return df.withColumns(
        {
            "_row_hash": row_hash(df, hash_mode),
            "_bronze_insert_ts": now,
            "_bronze_update_ts": now,
            "_code_version": F.lit(code_version).cast("string"),
            SOURCE: source_file(df, source),
        }
    )


def stamp_batches(df: DataFrame, batches: Sequence[str], clock: datetime) -> DataFrame:
    """Give every landing batch its own insert time, rising in name order (M4).

    ``batches`` are the names of the batches being read, the list the scan was built
    from. One scan reads them all; the n-th name gets the clock plus n microseconds.
    """
    spark = df.sparkSession
    start = clock_micros(clock)
    times = spark.createDataFrame(
        [(name, start + n) for n, name in enumerate(sorted(set(batches)))],
        "__batch string, __micros long",
    )
    now = F.timestamp_micros("__micros")
    joined = df.withColumn("__of", batch_of(column(SOURCE))).join(
        broadcast_if_small(times, len(batches)), F.col("__of") == F.col("__batch"), "left"
    )
    return joined.withColumns({"_bronze_insert_ts": now, "_bronze_update_ts": now}).drop(
        "__of", "__batch", "__micros"
    )
