"""Landing to bronze (P1), also for dated snapshot files (P5), with a report per table (Q3)."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import datetime
from threading import Event, Thread
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.functions.columns import column
from varve.functions.times import clock_micros
from varve.operators.metadata import add_basic_metadata, stamp_batches
from varve.operators.quality import CORRUPT, split_corrupt
from varve.operators.versioning import (
    add_version_flags,
    drifted,
    key_times,
    part_of,
    union_history,
    upsert_versions,
    with_key_times,
)
from varve.session import discard, fresh_dir, materialize, materialize_counted, tidy
from varve.sources.files import manifest, new_files, read_csv, read_jsonl
from varve.sources.folders import Folder
from varve.sources.store import CODEC, GENERATIONS, LATEST, Commit, Store, bucket_of
from varve.spec import TableSpec, Zones


@dataclass(frozen=True)
class Outcome:
    """What one table's load did."""

    table: str
    status: str  # "loaded", "no new files", "failed" or "timed out"
    rows: int = 0
    corrupt: int = 0
    error: str | None = None


FAILED = ("failed", "timed out")

# Column that names the part of a staged row.
PART = "__part"
# Bytes of landing text that are flagged and stored at once, as far as parts go; how much smaller
# packed text is; and the most parts, since each writes files of its own to every bucket.
PART_BYTES, PACKED, MOST_PARTS = 32 << 20, 4, 24


class LoadFailure(Exception):
    """Some tables failed; the others are done. ``outcomes`` has all of them."""

    def __init__(self, outcomes: list[Outcome]) -> None:
        self.outcomes = outcomes
        failed = {o.table: o.error for o in outcomes if o.status in FAILED}
        super().__init__(f"{len(failed)} of {len(outcomes)} tables failed: {failed}")


def waiting(
    spark: SparkSession, store: Store, table: str, base: Commit | None = LATEST
) -> DataFrame:
    """The landing files of a table that it has not taken in yet."""
    found = manifest(spark, store.zones.landing, [table])
    return new_files(found, store.consumed(table, base), on="file")


def key_as_stored(df: DataFrame, spec: TableSpec, base: Commit | None) -> DataFrame:
    """New rows with their key in the type the table stores it in, where that is the wider one.

    Buckets and hashes go by a key's text, and 1 and 1.0 must be one key.
    """
    if base is None:
        return df
    for name, kind in drifted(base.schema, df.schema).items():
        stored = base.schema[name].dataType
        as_text = kind is None and spec.drift == "string" and isinstance(stored, T.StringType)
        if name in spec.key and (kind == stored or as_text):
            df = df.withColumn(name, column(name).cast(stored))
    return df


def scan(spark: SparkSession, spec: TableSpec, paths: Sequence[str], ext: str) -> DataFrame:
    """All new batches in one scan."""
    if ext == "csv":
        return read_csv(spark, paths, spec.schema, spec.quote_escape, spec.multiline)
    return read_jsonl(spark, paths, spec.schema)


def text_bytes() -> Column:
    """About how much text the files of a manifest hold."""
    return F.sum(F.when(F.col("file").endswith(".gz"), F.col("length") * PACKED).otherwise(F.col("length")))


def parts_for(size: int) -> int:
    """Parts in which rows of so many bytes of landing text are flagged and stored."""
    return max(1, min(MOST_PARTS, -(-size // PART_BYTES)))


def stamped(
    df: DataFrame, spec: TableSpec, batches: Sequence[str], clock: datetime, code_version: str | None
) -> DataFrame:
    """Metadata columns and one insert time per batch (M4-M8)."""
    rows = add_basic_metadata(df, clock, code_version, hash_mode=spec.hash_mode)
    return stamp_batches(rows, batches, clock)


def ingest_bronze(
    spark: SparkSession,
    zones: Zones,
    spec: TableSpec,
    clock: datetime,
    code_version: str | None = None,
    store: Store | None = None,
    archive: bool = False,
) -> Outcome:
    """Take a table's new landing batches into bronze.

    The new rows are parsed once and written with their metadata; all later steps read
    that. Only the buckets their keys fall in are read from the history and replaced. The
    list of the files taken in is part of the same commit, so a run that dies leaves
    nothing half done and a run without new files does nothing. ``archive`` moves the
    files taken in to ``processed/`` afterwards.
    """
    store = store or Store(spark, zones)
    # Read once: what the load selects, reads and replaces all hangs on this commit.
    base = store.commit_of(spec.name)
    # The files are looked up and compared with those taken in once; the staged list tells the rest.
    stage, found = store.stage_files(spec.name, waiting(spark, store, spec.name, base), "length")
    # One row per landing batch: Spark's own file index of the scan holds more.
    batches = sorted(found.groupBy("batch", "folder", "ext").agg(text_bytes().alias("bytes")).collect())
    if not batches:
        return Outcome(spec.name, "no new files")
    exts = {b["ext"] for b in batches}
    if len(exts) > 1:
        raise TypeError(f"mixed file types in {spec.name!r}: {sorted(exts)}")
    names, folders = [b["batch"] for b in batches], [b["folder"] for b in batches]
    scanned = key_as_stored(scan(spark, spec, folders, exts.pop()), spec, base)
    rows = stamped(scanned, spec, names, clock, code_version)
    outcome = load_rows(store, spec, rows, stage, clock, len(names), base, parts_for(sum(b["bytes"] for b in batches)))
    if archive:
        done = Folder(spark, f"{zones.landing}/{spec.name}/processed")
        for folder in folders:
            done.move(folder)
    return outcome


def load_rows(
    store: Store,
    spec: TableSpec,
    rows: DataFrame,
    files: str | None,
    clock: datetime,
    batches: int = 1,
    base: Commit | None = LATEST,
    parts: int = 1,
) -> Outcome:
    """Add stamped rows to a bronze table and bring its flags up to date.

    ``base`` is the commit by which the files were selected. A load that commits meanwhile
    makes this one fail; repeated, it takes in what is still waiting. A first load goes a
    part of the rows after the other, in ``parts`` by their hashes, which bounds what is
    shuffled at once; the staged rows of a part go when it is stored.
    """
    table, key = spec.name, spec.key
    commit = store.commit_of(table) if base is LATEST else base
    last = clock_micros(clock) + batches - 1
    if commit is not None and clock_micros(clock) <= commit.clock:
        raise ValueError(f"the clock {clock} is not later than the newest batch of {table!r}")

    missing = [k for k in key if k not in rows.columns]
    if missing:
        raise KeyError(f"{table!r} has no key columns {missing}")
    buckets = commit.buckets if commit else store.buckets
    # A first load replaces no buckets, and goes by parts.
    by = {} if commit or parts == 1 else {PART: part_of(parts)}
    wanted = {"buckets": F.collect_set(bucket_of(key, buckets))} if commit else {}
    path = fresh_dir(store.spark, "staged")
    with tidy(store.spark):
        staged, counts = materialize_counted(
            rows.withColumns(by),
            "staged",
            *by,
            codec=CODEC,
            path=path,
            corrupt=F.count(CORRUPT if CORRUPT in rows.columns else F.lit(None)),
            **wanted,
        )
    new, _ = split_corrupt(staged.drop(PART))
    good = counts["rows"] - counts["corrupt"]
    outcome = Outcome(table, "loaded", good, counts["corrupt"])
    covers = spec.hash_mode == "strict" and not any(k.startswith("_") for k in key)

    history = store.read_or_none(table, base=commit)
    if history is not None and not _retypes(history, new):
        # Rows that are no longer latest never change again: they are neither read whole
        # nor written, but for buckets where they have come to lie in many folders.
        touched = counts["buckets"]
        merged = upsert_versions(
            store.read_or_none(table, touched, is_open=True, base=commit),
            new,
            key,
            drift=spec.drift,
            new_rows=good,
            # A hash that covers the key lies in its key's bucket; any other one may lie anywhere.
            hash_history=store.read_or_none(table, touched, base=commit) if covers else store.read_content(table, new, commit),
        )
        compact = [b for b in touched if len(commit.parts.get(commit.part(b, False), [])) >= GENERATIONS]
        if compact:
            closed = store.read_or_none(table, compact, is_open=False, base=commit)
            merged = merged.unionByName(closed, allowMissingColumns=True)
        store.replace_buckets(merged, table, touched, compact, files, last, base=commit, index=not covers)
        discard(store.spark, path)
        return outcome
    folders = [f"{path}/{n}" for n in Folder(store.spark, path).names() if n.startswith(f"{PART}=")]
    if folders:
        times = fresh_dir(store.spark, "times")
        with tidy(store.spark):
            by_key, keys = materialize_counted(key_times(new, key), "times", path=times)

        def flagged_parts():
            for folder in folders:
                some, _ = split_corrupt(store.spark.read.schema(rows.schema).parquet(folder))
                yield add_version_flags(with_key_times(some, by_key, key, keys["rows"]), key, timed=True)
                discard(store.spark, folder)

        store.replace(flagged_parts(), table, key, "_latest", files, last, base=commit, index=not covers)
        discard(store.spark, path, times)
        return outcome
    # A first load; or a column changed its type, which stored files cannot do in place.
    whole = new if history is None else union_history(history, new, spec.drift)
    flagged = add_version_flags(whole, key, hash_covers_key=covers)
    store.replace(flagged, table, key, "_latest", files, last, base=commit, index=not covers)
    discard(store.spark, path)
    return outcome


def _retypes(history: DataFrame, new: DataFrame) -> bool:
    """Whether a column of the history must change its type to take in the new rows.

    A column that is text already stays so; the new rows alone are turned to text.
    """
    stored = {name: (history.schema[name].dataType, kind) for name, kind in drifted(history.schema, new.schema).items()}
    return any(kind != old and not (kind is None and isinstance(old, T.StringType)) for old, kind in stored.values())


def quarantined(
    spark: SparkSession, spec: TableSpec, paths: Sequence[str], ext: str = "jsonl"
) -> DataFrame:
    """The lines of landing files that do not parse, with their file (Q4)."""
    return split_corrupt(materialize(scan(spark, spec, paths, ext), "scanned"))[1]


class _Deadline:
    """Cancels the Spark jobs that this thread starts, once ``seconds`` have passed."""

    def __init__(self, spark: SparkSession, seconds: float) -> None:
        self._context, self._tag = spark.sparkContext, f"varve-{uuid4().hex}"
        self._seconds, self._over, self.passed = seconds, Event(), False

    def _watch(self) -> None:
        pause = self._seconds
        # A load is many jobs, and one may begin just after another was cancelled.
        while not self._over.wait(pause):
            self.passed, pause = True, 0.2
            self._context.cancelJobsWithTag(self._tag)

    def __enter__(self) -> _Deadline:
        self._context.addJobTag(self._tag)
        Thread(target=self._watch, daemon=True).start()
        return self

    def __exit__(self, *_) -> None:
        self._over.set()
        self._context.removeJobTag(self._tag)


def run_tables(
    tables: Mapping[str, Callable[[], Outcome]],
    at_once: int = 4,
    spark: SparkSession | None = None,
    deadlines: Mapping[str, float] | None = None,
) -> list[Outcome]:
    """Run every table's load, some at once; one failure does not stop the others (Q3).

    ``deadlines`` gives tables a number of seconds, from the start of their own load, after which
    their jobs of the session ``spark`` are cancelled, and those of no other table. A load that
    committed before counts as loaded; one that is cancelled leaves its table as it was.
    Raises :class:`LoadFailure` with the full report at the end if any failed or timed out.
    """
    deadlines = deadlines or {}
    if deadlines and spark is None:
        raise ValueError("deadlines need the session whose jobs they cancel")

    def run(table: str) -> Outcome:
        limit = _Deadline(spark, deadlines[table]) if table in deadlines else None
        try:
            with limit or nullcontext():
                return tables[table]()
        except Exception as error:
            logging.warning("%s failed: %r", table, error)
            return Outcome(table, "timed out" if limit and limit.passed else "failed", error=repr(error))

    with ThreadPoolExecutor(at_once) as pool:
        outcomes = list(pool.map(run, tables))
    if any(o.status in FAILED for o in outcomes):
        raise LoadFailure(outcomes)
    return outcomes


def report(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    """The outcomes as rows."""
    return spark.createDataFrame(
        [(o.table, o.status, o.rows, o.corrupt, o.error) for o in outcomes],
        "table string, status string, rows long, corrupt long, error string",
    )


def ingest_all(
    spark: SparkSession,
    zones: Zones,
    specs: Sequence[TableSpec],
    clock: datetime,
    code_version: str | None = None,
) -> list[Outcome]:
    """Load every table that has a landing folder; a folder without settings fails."""
    known = {s.name: s for s in specs}
    found = manifest(spark, zones.landing).select("table").distinct().collect()

    def load(table: str) -> Outcome:
        if table not in known:
            raise KeyError(f"no settings for landing table {table!r}")
        return ingest_bronze(spark, zones, known[table], clock, code_version)

    names = sorted(r["table"] for r in found)
    return run_tables({name: lambda name=name: load(name) for name in names})
