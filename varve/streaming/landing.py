"""Landing files as a stream (S20) and bronze kept up to date from it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from varve.operators.metadata import SOURCE, batch_of
from varve.plans.bronze import key_as_stored, load_rows, stamped
from varve.session import materialize
from varve.sources.files import MICROS, new_files, with_corrupt
from varve.sources.store import Store
from varve.spec import TableSpec, Zones


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    ext: str = "jsonl",
    archive: str | None = None,
    files_per_trigger: int | None = None,
    quote_escape: str = "\\",
) -> DataFrame:
    """New files of a landing folder, each once; the checkpoint knows which were read.

    ``archive`` moves files that are done; they move when a later batch runs, so the
    folder tells nothing about what has been read. Files below ``processed/`` are left
    out. A CSV file whose header differs from the schema's names fails the stream. Lines that
    do not parse keep their text in ``_corrupt_record``.
    """
    options = {"recursiveFileLookup": True, "pathGlobFilter": "*", **MICROS}
    if archive:
        options.update(cleanSource="archive", sourceArchiveDir=archive)
    if files_per_trigger:
        options["maxFilesPerTrigger"] = files_per_trigger
    reader = spark.readStream.options(**options)
    if ext == "csv":
        scan = reader.schema(with_corrupt(schema)).options(
            header=True, escape=quote_escape, enforceSchema=False
        ).csv(path)
    else:
        scan = reader.schema(with_corrupt(schema)).json(path)
    found = scan.select("*", F.col("_metadata.file_path").alias(SOURCE))
    # What a load by batch has taken in and moved away comes by here again.
    return found.where(~F.contains(SOURCE, F.lit("/processed/")))


def run_available(
    stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Hand all waiting files to ``each`` in micro-batches, then stop."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def append_once(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps one Parquet folder per micro-batch, so that a repeat replaces it."""

    def write(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write


def ingest_stream(
    spark: SparkSession,
    zones: Zones,
    spec: TableSpec,
    clock: Callable[[int], datetime],
    code_version: str | None = None,
    store: Store | None = None,
    files_per_trigger: int | None = None,
    ext: str = "jsonl",
) -> StreamingQuery:
    """Bronze from a landing stream; the same table as loads by batch.

    ``clock`` gives a micro-batch's time. Each landing batch still has its own insert
    time, so write a batch under another name and move it in whole, and leave
    ``files_per_trigger`` unset if batches are folders of part files. Files already in
    the table are skipped, so a micro-batch that Spark repeats is not loaded twice.
    """
    if spec.schema is None:
        raise ValueError("a stream needs a schema")
    store = store or Store(spark, zones)

    def load(rows: DataFrame, epoch: int) -> None:
        base = store.commit_of(spec.name)
        staged = materialize(rows, "stream")
        files = staged.select(
            F.lit(spec.name).alias("table"),
            batch_of(F.col(SOURCE)).alias("batch"),
            F.col(SOURCE).alias("folder"),
            F.lit(ext).alias("ext"),
            F.col(SOURCE).alias("file"),
        ).distinct()
        stage, fresh = store.stage_files(
            spec.name, new_files(files, store.consumed(spec.name, base), on="file")
        )
        names = [r["batch"] for r in fresh.select("batch").distinct().collect()]
        if not names:
            return
        now = clock(epoch)
        wanted = staged.join(fresh.select("file"), F.col(SOURCE) == F.col("file"), "left_semi")
        versions = stamped(key_as_stored(wanted, spec, base), spec, names, now, code_version)
        load_rows(store, spec, versions, stage, now, len(names), base)

    stream = stream_landing(
        spark, f"{zones.landing}/{spec.name}", spec.schema, ext,
        files_per_trigger=files_per_trigger, quote_escape=spec.quote_escape,
    )
    return run_available(stream, f"{zones.control}/stream/{spec.name}", load)
