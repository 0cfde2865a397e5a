"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.functions.columns import column
from varve.session import written_report

CORRUPT = "_corrupt_record"
# Fixed value: what the body of an empty listing says.
NO_RECORDS = "no records found"


def reconcile(expected: int, df: DataFrame) -> DataFrame:
    """The expected and the found number of rows, and whether they agree (Q1)."""
    return df.agg(F.lit(expected).cast("long").alias("expected"), F.count("*").alias("found")).select(
        "expected", "found", (F.col("expected") == F.col("found")).alias("ok")
    )


def totals(
    rows: DataFrame, declared: DataFrame, source: str | Sequence[str], declared_col: str
) -> DataFrame:
    """Rows received per source against the source's declared total (Q2).

    A source that declared rows and delivered none is listed too.
    """
    source = [source] if isinstance(source, str) else list(source)
    received = rows.groupBy(*source).agg(F.count("*").alias("received"))
    stated = declared.groupBy(*source).agg(F.max(column(declared_col)).alias("declared"))
    return (
        stated.join(received, source, "full_outer")
        .withColumn("received", F.coalesce("received", F.lit(0)))
        .withColumn("ok", F.col("declared").eqNullSafe(F.col("received")))
    )


def listing_complete(
    pages: DataFrame,
    listing: str | Sequence[str],
    page: str = "page",
    total_pages: str = "total_pages",
    total_record: str = "total_record",
    received: str = "received",
    message: str = "message",
) -> DataFrame:
    """Whether each listing's landed pages are all there, one row per listing.

    ``pages`` has a row for each body: its page number, the totals that it declares, the
    rows it ``received`` and its message. A listing is ok when its pages agree on both
    totals, every page from 1 to the last one is there, and the rows add up to the total.
    One of which all bodies say that there are no records, and hold none, is ok too. A
    null listing is one of its own; one without any body cannot be seen here.
    """
    listing = [listing] if isinstance(listing, str) else list(listing)
    number, last, stated = column(page), column(total_pages), column(total_record)
    nothing = F.coalesce(F.lower(F.trim(column(message))) == NO_RECORDS, F.lit(False))
    found = pages.groupBy(*listing).agg(
        F.max(last).cast("long").alias("declared_pages"),
        F.count_distinct(F.when(number.between(1, last), number)).alias("found_pages"),
        F.max(stated).cast("long").alias("declared"),
        F.coalesce(F.sum(column(received)), F.lit(0)).cast("long").alias("received"),
        ((F.min(last) == F.max(last)) & (F.min(stated) == F.max(stated))).alias("_agree"),
        F.bool_and(nothing).alias("_nothing"),
    )
    whole = F.col("_agree") & (F.col("found_pages") == F.col("declared_pages")) & (F.col("received") == F.col("declared"))
    ok = F.when(F.col("_nothing"), F.col("received") == 0).otherwise(F.coalesce(whole, F.lit(False)))
    return found.withColumn("ok", ok).drop("_agree", "_nothing")


def require(report: DataFrame, what: str) -> None:
    """Fail when a report has rows that are not ``ok``; all are written, a few are named."""
    path, rows = written_report(report.where("NOT ok"), "report")
    if rows:
        some = [row.asDict() for row in report.sparkSession.read.parquet(path).take(3)]
        raise ValueError(f"{what}: {rows} rows, all in {path}, such as {some}")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the corrupt column, and the text of the bad lines (Q4).

    A line that broke has its text in ``_corrupt_record``.
    """
    if CORRUPT not in df.columns:
        return df, df.select(F.lit(None).cast("string").alias(CORRUPT)).where(F.lit(False))
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    kept = [c for c in df.columns if c == CORRUPT or c.startswith("_raw_")]
    return good, df.where(F.col(CORRUPT).isNotNull()).select(*kept)


def formats(manifest: DataFrame) -> DataFrame:
    """The file formats waiting in each table folder, and whether there is just one."""
    return manifest.groupBy("table").agg(
        F.array_sort(F.collect_set("ext")).alias("formats")
    ).withColumn("ok", F.size("formats") <= 1)


def verify_checksums(files: DataFrame, expected: DataFrame, name: str = "name") -> DataFrame:
    """Files whose bytes are checked against a manifest of ``name`` and ``checksum``.

    ``files`` has ``content`` (bytes). The checksum reads ``sha256:<hex>``; a manifest
    name without a file, or a file without one, is not ok. Only names and digests shuffle.
    """
    found = files.select(
        column(name), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("found")
    )
    return expected.select(column(name), "checksum").join(found, name, "full_outer").withColumn(
        "ok", F.coalesce(F.col("checksum") == F.col("found"), F.lit(False))
    )

