"""Landing files: scans, manifest, name routing, landing writes."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.functions.columns import column
from varve.operators.metadata import BATCH_NAME, BATCH_PATTERN, SOURCE
from varve.functions.times import utc
from varve.operators.quality import CORRUPT
from varve.session import tidy
from varve.sources.folders import Folder
from varve.sources.quoted import BLOCK_BYTES, Dialect, parse_records, read_records
from varve.spec import Zones, plain_name

# Landing text keeps microseconds; Spark's default would cut to milliseconds.
MICROS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Names of transaction files; parts are table, date and time.
TRANSACTION_FILES = (
    r"^(Transactions|Declines)_?(\d{4}-?\d{2}-?\d{2})_?(\d{2}-?\d{2}-?\d{2})?\.csv$"
)


def as_struct(schema: T.StructType | str) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def with_corrupt(schema: T.StructType | str) -> T.StructType:
    """``schema`` with the column that takes the text of lines that do not parse."""
    schema = as_struct(schema)
    if CORRUPT in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _with_source(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias(SOURCE))


def read_jsonl(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON lines; a line that holds an array gives one row per element.

    All paths are one scan, columns merged by name. Without ``schema`` the files are read
    once more to infer it. Lines that are null or broken keep their text in
    ``_corrupt_record`` (present with a schema, or where inference met one).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.options(**MICROS)
    if schema is not None:
        reader = reader.schema(with_corrupt(schema))
    return _with_source(reader.json(paths))


def csv_headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Paths grouped by the column names of their first line; one line is read per path."""

    def header(path: str) -> tuple[str, ...]:
        names = next(csv.reader([Folder(spark, path).first_line().lstrip("\ufeff")]), [])
        return tuple(name or f"_c{n}" for n, name in enumerate(names))

    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for path, names in zip(paths, pool.map(header, paths)):
            groups.setdefault(names, []).append(path)
    return groups


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    quote_escape: str = "\\",
    multiline: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """CSV with a header, all columns text unless a schema types them.

    A path is a file or a folder of files with one header. Paths are scanned together per
    distinct header and united by column name. ``multiline`` keeps line breaks inside
    quotes; a task then reads ``block_bytes`` of a file, however large it is. The default
    splits at every line break. A line with too few or too many fields, or with text that
    does not read as its column's type, keeps its text in ``_corrupt_record``. Spark finds
    such lines only where that column is read, so stage the rows with it.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    kinds = {f.name: f.dataType for f in as_struct(schema)} if schema is not None else {}
    reader = spark.read.options(header=True, escape=quote_escape, **MICROS)
    scans = []
    for names, group in csv_headers(spark, paths).items():
        if not names:
            continue
        fields = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
        # A part file of a folder whose header differs from the first one's must not be
        # read by position.
        unnamed = any(n.startswith("_c") for n in names)
        if multiline:
            records = read_records(spark, group, Dialect(escape=quote_escape), block_bytes)
            options = {"escape": quote_escape, "multiLine": "true", **MICROS}
            source = F.col("path").alias(SOURCE)
            scans.append(parse_records(records, with_corrupt(fields), options, not unnamed, [source]))
            continue
        checked = reader.option("enforceSchema", unnamed)
        scans.append(_with_source(checked.schema(with_corrupt(fields)).csv(group)))
    if not scans:
        return spark.createDataFrame([], T.StructType([T.StructField(SOURCE, T.StringType())]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def rows_to_df(spark: SparkSession, rows: list[dict], schema: T.StructType | str) -> DataFrame:
    """A few rows in memory, such as settings or a manifest, as a DataFrame."""
    return spark.createDataFrame(rows, schema)


def manifest(spark: SparkSession, root: str, tables: Sequence[str] | None = None) -> DataFrame:
    """The files waiting below ``root/<table>/``, without their content.

    One row per file: ``table``, ``batch`` and ``folder`` (name and path of the landing
    batch, a file or a folder of part files), ``path``, ``file`` (the path as scans give
    it), ``name``, ``ext``, ``length``, ``mtime``. Only ``.jsonl`` and ``.csv`` batches
    right below the table folder count, so those moved to ``processed/`` do not.
    """
    home = Folder(spark, root).path
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load([f"{home}/{plain_name(t, 'table')}" for t in tables] if tables else home)
    )
    below = F.substring("path", len(home) + 2, 1 << 30)
    inside = f"^([^/]+)/{BATCH_PATTERN}"
    return files.select(
        F.regexp_extract(below, inside, 1).alias("table"),
        F.regexp_extract(below, inside, 2).alias("batch"),
        F.regexp_extract("path", f"^(.*?/{BATCH_NAME})(?:/[^/]+)?$", 1).alias("folder"),
        "path",
        F.col("_metadata.file_path").alias("file"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.element_at(F.split(F.regexp_extract(below, inside, 2), r"\."), -1).alias("ext"),
        "length",
        F.col("modificationTime").alias("mtime"),
    ).where("batch <> ''")


def route_files(
    files: DataFrame,
    pattern: str = TRANSACTION_FILES,
    groups: Sequence[str] = ("table", "date", "time"),
    name: str = "name",
) -> tuple[DataFrame, DataFrame]:
    """Split files by a name pattern; its groups become columns, ``date`` a date.

    An optional part that is absent is null. The second result has the names that do not
    match, to be reported and not loaded.
    """
    matches = F.coalesce(column(name).rlike(pattern), F.lit(False))
    parts: dict[str, Column] = {
        g: F.nullif(F.regexp_extract(column(name), pattern, n + 1), F.lit(""))
        for n, g in enumerate(groups)
    }
    if "date" in parts:
        parts["date"] = F.to_date(F.replace(parts["date"], F.lit("-"), F.lit("")), "yyyyMMdd")
    routed = files.where(matches).withColumns(parts)
    return routed, files.where(~matches)


def new_files(candidates: DataFrame, seen: DataFrame, on: str | Sequence[str] = "name") -> DataFrame:
    """Candidates whose name is not among those seen."""
    on = [on] if isinstance(on, str) else list(on)
    return candidates.join(seen.select(*on), on, "left_anti")


def land_jsonl(
    df: DataFrame,
    zones: Zones,
    table: str,
    batch: str,
    drop_empty: bool = True,
    keep_nulls: bool = False,
    codec: str = "none",
) -> int:
    """Write rows as one new landing batch of JSON lines and give their number (K1, K5).

    The rows are counted by the write itself. An empty batch writes no data file, so that
    it never shows up in the manifest, or fails if that is not wanted. ``codec``
    (``"gzip"``) packs the files.
    """
    plain_name(table, "table"), plain_name(batch, "batch")
    counted = Observation()
    path = f"{zones.landing}/{table}/{batch}.jsonl"
    (
        df.observe(counted, F.count("*").alias("rows"))
        .write.options(ignoreNullFields=not keep_nulls, compression=codec, **MICROS)
        .json(path)
    )
    rows = counted.get["rows"]
    if rows == 0 and not drop_empty:
        raise ValueError(f"batch {batch!r} of {table!r} is empty")
    return rows


def land_batches(
    df: DataFrame, zones: Zones, table: str, name: str, ext: str = "jsonl", codec: str = "none"
) -> None:
    """Write many landing batches at once; the column ``name`` names each row's batch (K1).

    Rebalancing gives every batch few files, and several to a batch that is large. ``codec``
    (``"gzip"``) packs the files; one that is packed cannot be read by ``multiline`` scans.
    """
    if "batch" in df.columns:
        raise ValueError("a column named 'batch' would be lost in the folder names")
    named = df.withColumn("batch", F.concat(column(name), F.lit(f".{ext}"))).drop(name)
    writer = (
        named.hint("rebalance", "batch")
        .write.mode("append")
        .partitionBy("batch")
        .options(compression=codec, **MICROS)
    )
    path = f"{zones.landing}/{plain_name(table, 'table')}"
    with tidy(df.sparkSession):
        if ext == "csv":
            writer.options(
                header=True,
                escape='"',
                ignoreLeadingWhiteSpace=False,
                ignoreTrailingWhiteSpace=False,
            ).csv(path)
        else:
            writer.json(path)


def lookback_start(clock: datetime, days: int) -> datetime:
    """First moment of the default extract window."""
    day = utc(clock).replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=None)
    return day - timedelta(days=days)
