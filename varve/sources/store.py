"""Tables of a zone: read, replace, replace buckets, commit.

Without a table format that has transactions, overwriting Parquet that is being read
loses it. A write here goes to a new generation folder, and one small commit file then
says which folders the table consists of and which landing batches it has taken in. A
job that dies before the commit leaves the table as it was, and readers never see half
a write.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.functions.columns import column
from varve.operators.known import bitmaps_for, content_bitmaps, may_hold
from varve.operators.versioning import ROW_HASH
from varve.session import tidy
from varve.sources.folders import Folder
from varve.spec import Zones, one_of, plain_name

BUCKET = "_bucket"
FILES = "table string, batch string, folder string, ext string, file string"
KNOWN = "part string, bitmaps int, slot int, bits binary, gen string"

# Stands for the newest commit, where a caller has not read one yet.
LATEST: Any = object()

# Half the size of Spark's default for text of hex digits, which it does not pack at all.
CODEC = "zstd"

# Generations a closed part may be spread over before a load writes it as one again.
GENERATIONS = 32


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """Bucket of a key; its text is hashed, so that a widened type keeps its bucket."""
    values = [column(k).cast("string") for k in key]
    return F.pmod(F.xxhash64(*values), F.lit(buckets)).cast("int")


@dataclass
class Commit:
    """What a table consists of after one write.

    A part is a bucket, or the open or closed rows of one, or the whole table; its rows
    are in the folders of one or more generations.
    """

    version: int
    schema: T.StructType
    parts: dict[str, list[str]]
    buckets: int | None = None
    key: list[str] = field(default_factory=list)
    split: str | None = None  # the flag that tells open from closed rows
    clock: int = 0  # newest batch time, in microseconds
    consumed: list[str] = field(default_factory=list)  # staged lists of files taken in
    rows: int = 0  # rows this write wrote
    origin: dict[int, list[str]] = field(default_factory=dict)  # buckets it was derived from
    rule: str = ""  # how it was derived from them

    def part(self, bucket: int | None, is_open: bool | None = None) -> str:
        if bucket is None:
            return ""
        flag = f"/{self.split}={str(is_open).lower()}" if self.split else ""
        return f"{BUCKET}={bucket}{flag}"

    def open_buckets(self) -> dict[int, list[str]]:
        """The generations of every bucket's open rows."""
        found = {b: self.parts.get(self.part(b, True)) for b in range(self.buckets or 0)}
        return {b: generations for b, generations in found.items() if generations}

    def to_json(self) -> str:
        origin = {str(b): g for b, g in self.origin.items()}
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue(), "origin": origin})

    @staticmethod
    def from_json(text: str) -> Commit:
        values = json.loads(text)
        values["schema"] = T.StructType.fromJson(values["schema"])
        values["origin"] = {int(b): g for b, g in values["origin"].items()}
        return Commit(**values)


class Store:
    """Versioned Parquet tables of one zone of a source."""

    def __init__(self, spark: SparkSession, zones: Zones, zone: str = "bronze", buckets: int = 64):
        self.spark, self.zones, self.zone, self.buckets = spark, zones, zone, buckets

    def _root(self, table: str) -> str:
        return f"{self.zones.path(self.zone)}/{plain_name(table, 'table')}"

    def _control(self, table: str) -> str:
        return f"{self.zones.control}/{self.zone}/{plain_name(table, 'table')}"

    def _commits(self, table: str) -> Folder:
        return Folder(self.spark, f"{self._control(table)}/commits")

    def tables(self) -> list[str]:
        """Names of the tables that have been committed."""
        names = Folder(self.spark, f"{self.zones.control}/{self.zone}").names()
        return [n for n in names if self.commit_of(n) is not None]

    def commit_of(self, table: str) -> Commit | None:
        folder = self._commits(table)
        names = [n for n in folder.names() if n.endswith(".json") and not n.startswith(".")]
        return Commit.from_json(folder.read(names[-1])) if names else None

    def read_or_none(
        self,
        table: str,
        buckets: Iterable[int] | None = None,
        is_open: bool | None = None,
        base: Commit | None = LATEST,
    ) -> DataFrame | None:
        """The table, or None before its first load.

        ``buckets`` reads some buckets only, ``is_open`` only open or only closed rows;
        ``base`` reads the table as that commit left it.
        """
        commit = self.commit_of(table) if base is LATEST else base
        if commit is None:
            return None
        parts = commit.parts
        if commit.buckets and (buckets is not None or is_open is not None):
            chosen = range(commit.buckets) if buckets is None else buckets
            states = [is_open] if is_open is not None else [True, False]
            names = {commit.part(b, state) for b in chosen for state in states}
            parts = {name: parts[name] for name in names if name in parts}
        return self._read_parts(table, commit, parts)

    def _read_parts(self, table: str, commit: Commit, parts: dict[str, list[str]], with_part: bool = False) -> DataFrame:
        root = self._root(table)
        paths = [f"{root}/gen={g}/{part}" for part, found in parts.items() for g in found]
        if not paths:
            return self.spark.createDataFrame([], commit.schema)
        # The schema comes from the commit: no footer merge, and a column that an older
        # generation lacks reads as null.
        schema = T.StructType(commit.schema.fields + [T.StructField("gen", T.StringType())])
        if commit.buckets:
            schema = schema.add(BUCKET, T.IntegerType())
        found = self.spark.read.option("basePath", root).schema(schema).parquet(*paths)
        # All parts of a table have as many levels; a regular expression per row would take longer.
        levels = 1 + next(iter(parts)).count("/")
        below = F.substring_index(F.substring_index("_metadata.file_path", "/", -1 - levels), "/", levels)
        named = [below.alias("part")] if with_part else []
        return found.select(*[column(n) for n in commit.schema.names], *named)

    def read(self, table: str) -> DataFrame:
        """The whole table."""
        df = self.read_or_none(table)
        if df is None:
            raise FileNotFoundError(f"table {table!r} has not been loaded yet")
        return df

    def consumed(self, table: str, base: Commit | None = LATEST) -> DataFrame:
        """The landing files the table has taken in (K6)."""
        commit = self.commit_of(table) if base is LATEST else base
        staged = commit.consumed if commit else []
        paths = [f"{self._control(table)}/consumed/gen={g}" for g in staged]
        if not paths:
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(*paths)

    def stage_files(self, table: str, files: DataFrame, *more: str) -> tuple[str, DataFrame]:
        """Write the list of files about to be taken in; it counts once a commit names it.

        ``more`` are columns of ``files`` that the list that is read back has too.
        """
        stage = uuid4().hex
        path = f"{self._control(table)}/consumed/gen={stage}"
        listed = files.select(column("table"), "batch", "folder", "ext", "file", *more)
        listed.write.parquet(path)
        return stage, self.spark.read.schema(listed.schema).parquet(path)

    def replace(
        self,
        df: DataFrame | Iterable[DataFrame],
        table: str,
        key: Sequence[str] | None = None,
        split: str | None = None,
        files: str | None = None,
        clock: int = 0,
        base: Commit | None = LATEST,
        index: bool = False,
        **derived,
    ) -> Commit:
        """Make ``df`` the table, whatever it was; ``df`` may read the table (K2, K3).

        Several frames of one schema are written one after the other, and are one table.

        With ``key`` the rows are laid out in buckets, so that later loads can replace
        some of them; with ``split``, a flag that never turns true again, its closed rows
        (flag false) are kept apart. ``files`` names a staged list of files, taken in by
        this commit. ``base`` is the commit that ``df`` was made from: should another
        writer have committed since, the write fails and leaves that one's table. ``index``
        keeps bitmaps of the row hashes, for :meth:`read_content`.
        """
        old = self.commit_of(table) if base is LATEST else base
        buckets = (old.buckets if old and old.buckets else self.buckets) if key else None
        layout = {"key": list(key or []), "buckets": buckets, "split": split if key else None}
        return self._write(df, table, old, {}, layout, files, clock, index, derived)

    def replace_buckets(
        self,
        df: DataFrame,
        table: str,
        buckets: Iterable[int],
        compact: Iterable[int] = (),
        files: str | None = None,
        clock: int = 0,
        base: Commit | None = LATEST,
        index: bool = False,
        **derived,
    ) -> Commit:
        """Make ``df`` the content of the named buckets; others stay (K4).

        In a split table it is their whole open content, and closed rows of ``df`` are
        added to those stored, or replace them in the buckets to ``compact``. ``base`` and
        ``index`` are as in :meth:`replace`.
        """
        old = self.commit_of(table) if base is LATEST else base
        if old is None or old.buckets is None:
            raise ValueError(f"table {table!r} is not laid out in buckets")
        gone = {old.part(b, True) for b in buckets} | {old.part(b, False) for b in compact}
        kept = {part: found for part, found in old.parts.items() if part not in gone}
        layout = {"key": old.key, "buckets": old.buckets, "split": old.split}
        return self._write(df, table, old, kept, layout, files, clock, index, derived)

    def read_content(self, table: str, new: DataFrame, base: Commit) -> DataFrame:
        """The stored rows among which are all that have the row hash of a row of ``new``.

        Only parts whose bitmaps share a place with the new hashes are read; a part without bitmaps is.
        """
        root = f"{self._control(table)}/known"
        made = set(Folder(self.spark, root).names())
        parts = [(part, g) for part, found in base.parts.items() for g in found]
        listed = [(part, g) for part, g in parts if f"gen={g}" in made]
        if not listed:
            return self.read_or_none(table, base=base)
        paths = [f"{root}/gen={g}" for g in sorted({g for _, g in listed})]
        index = self.spark.read.option("basePath", root).schema(KNOWN).parquet(*paths)
        held = {(r["part"], r["gen"]) for r in may_hold(index, ["part", "gen"], new).collect()}
        chosen: dict[str, list[str]] = {}
        for part, g in parts:
            if f"gen={g}" not in made or (part, g) in held:
                chosen.setdefault(part, []).append(g)
        return self._read_parts(table, base, chosen)

    def _know(self, table: str, generation: str, parts: Sequence[str], rows: int) -> None:
        """Write the bitmaps of a generation, from the hash column just stored."""
        commit = Commit(0, T.StructType([T.StructField(ROW_HASH, T.StringType())]), {p: [generation] for p in parts}, buckets=1)
        stored = self._read_parts(table, commit, commit.parts, with_part=True)
        index = content_bitmaps(stored, ["part"], bitmaps_for(-(-rows // max(len(parts), 1))))
        with tidy(self.spark):
            index.write.option("compression", CODEC).parquet(f"{self._control(table)}/known/gen={generation}")

    def touched(self, table: str, new: DataFrame) -> list[int]:
        """The buckets the keys of ``new`` fall in; at most as many as the table has."""
        commit = self.commit_of(table)
        found = new.select(bucket_of(commit.key, commit.buckets).alias("bucket")).distinct()
        return sorted(row["bucket"] for row in found.collect())

    def _write(self, df, table, old, kept, layout, files, clock, index, derived) -> Commit:
        generation = uuid4().hex
        path = f"{self._root(table)}/gen={generation}"
        commit = Commit(
            version=(old.version if old else 0) + 1,
            schema=T.StructType([]),
            parts=dict(kept),
            clock=max(clock, old.clock if old else 0),
            consumed=(old.consumed if old else []) + ([files] if files else []),
            **layout,
            **derived,
        )
        names: set[str] = set()
        for frame in [df] if isinstance(df, DataFrame) else df:
            commit.schema = _nullable(frame.schema)
            with tidy(self.spark):
                rows, found = self._write_frame(frame, commit, path)
            commit.rows += rows
            names.update(found)
        for name in sorted(names):
            commit.parts[name] = [*commit.parts.get(name, []), generation]
        if index and commit.buckets and names:
            self._know(table, generation, sorted(names), commit.rows)
        self._commits(table).create(f"{commit.version:08d}.json", commit.to_json())
        return commit

    def _write_frame(self, df: DataFrame, commit: Commit, path: str) -> tuple[int, list[str]]:
        """Add rows to a generation; their number, and the parts that have some."""
        counted, rows = Observation(), F.count("*").alias("rows")
        if not commit.buckets:
            df.observe(counted, rows).write.mode("append").option("compression", CODEC).parquet(path)
            return counted.get["rows"], [commit.part(None)]
        # Rebalancing splits a bucket that holds much of the table into several files.
        by = [BUCKET, commit.split] if commit.split else [BUCKET]
        laid_out = df.withColumn(BUCKET, bucket_of(commit.key, commit.buckets))
        laid_out = laid_out.hint("rebalance", *by)
        written = F.collect_set(F.struct(*by)).alias("parts")
        writer = laid_out.observe(counted, rows, written).write.mode("append")
        writer.partitionBy(*by).option("compression", CODEC).parquet(path)
        return counted.get["rows"], [commit.part(*part) for part in counted.get["parts"]]


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


# Conditions under which a plain path holds no table yet.
MISSING = ("PATH_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE", "DELTA_TABLE_NOT_FOUND")


def read_path_or_none(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """A table another writer keeps at a path, or None where there is none."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() in MISSING:
            return None
        raise


def replace_path(df: DataFrame, path: str, fmt: str = "delta") -> None:
    """Overwrite a table of a format with transactions, merging the schema (K2, K3)."""
    one_of(fmt, ("delta",), "format with transactions")
    df.write.format(fmt).mode("overwrite").option("mergeSchema", True).option(
        "overwriteSchema", True
    ).save(path)
