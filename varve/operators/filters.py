"""Filters, work lists and chunks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varve.functions.columns import column
from varve.functions.times import WORKLIST_DAYS, utc
from varve.session import materialize
from varve.spec import one_of

# The named status choices.
STATUS = {"open": [1], "closed": [0], "both": [0, 1]}

# The time columns an extract window may use.
WINDOW_COLUMNS = ("createdAt", "updatedAt")

# Fixed value: key pairs per chunk of a work list.
CHUNK_SIZE = 5000


def current(df: DataFrame, where: str | None = None) -> DataFrame:
    """Rows flagged ``_latest``, and the table's own SQL predicate if any (F1, F2)."""
    rows = df.where("_latest")
    return rows.where(where) if where else rows


def valid_as(df: DataFrame, col: str, kind: str) -> DataFrame:
    """Rows whose text in ``col`` reads as ``kind``."""
    return df.where(column(col).try_cast(kind).isNotNull())


def status_in(col: Column, choice: str) -> Column:
    """The status number is one the named choice allows."""
    one_of(choice, STATUS, "status choice")
    return col.try_cast("int").isin(STATUS[choice])


def recent(df: DataFrame, ts: str, clock: datetime | date, days: int = WORKLIST_DAYS) -> Column:
    """The time's date is after the clock's date less ``days``.

    Written as a bound on the bare column, so that file statistics can prune.
    """
    day = utc(clock).date() if isinstance(clock, datetime) else clock
    bound = F.lit(day - timedelta(days=days - 1))
    return column(ts) >= bound.cast(df.schema[ts].dataType)


def worklist(
    df: DataFrame,
    status_col: str,
    choice: str,
    ts: str,
    clock: datetime | date,
    key: str,
    columns: Sequence[str],
    days: int = WORKLIST_DAYS,
) -> DataFrame:
    """Distinct ``columns`` of rows with an allowed status or a recent time.

    All row versions count, not only the latest; empty and null keys drop.
    """
    wanted = status_in(column(status_col), choice) | recent(df, ts, clock, days)
    return (
        df.where(wanted).where(column(key) != "").select(*[column(c) for c in columns]).distinct()
    )


def extract_window(
    df: DataFrame,
    ts_col: str,
    start: date | datetime | str,
    days: int = 1,
    columns: Sequence[str] | None = None,
    allowed: Sequence[str] = WINDOW_COLUMNS,
) -> DataFrame:
    """Rows with ``start <= ts_col < start + days``, and the named columns only."""
    one_of(ts_col, allowed, "window column")
    begin = datetime.fromisoformat(str(start))
    kind = df.schema[ts_col].dataType
    lower, upper = (F.lit(str(t)).cast(kind) for t in (begin, begin + timedelta(days=days)))
    rows = df.where((column(ts_col) >= lower) & (column(ts_col) < upper))
    return project_fields(rows, columns) if columns else rows


def extract_gaps(
    windows: DataFrame, key: str, start: str, end: str, first: datetime, last: datetime, pieces: int = 256
) -> DataFrame:
    """The times between ``first`` and ``last`` that no extract window of an object covers.

    ``windows`` has a row for each window that was extracted, half open, of an object ``key``; they may
    overlap, touch, contain each other, come twice, or reach beyond the bounds. One row per object and
    gap: ``key``, ``gap_start``, ``gap_end``. Windows that are null at an end or end before they start
    cover nothing; an object that has none but such ones is one gap.

    The time is cut into ``pieces``. How far windows of earlier pieces reach is carried over as one
    number per object and piece, so only windows of one object and piece are sorted together.
    """
    kind = windows.schema[start].dataType
    low, high = (F.lit(str(t)).cast(kind) for t in (first, last))
    begun, done = F.greatest(column(start), low), F.least(column(end), high)
    objects = windows.select(column(key).alias("__key")).distinct()
    # Windows that begin together are one, up to the latest end.
    whole = windows.where(column(start).isNotNull() & column(end).isNotNull())
    held = whole.select(column(key).alias("__key"), begun.alias("__from"), done.alias("__to"))
    held = held.where("__to > __from").groupBy("__key", "__from").agg(F.max("__to").alias("__to"))
    step = max((last - first) / pieces, timedelta(microseconds=1))
    passed = F.timestamp_diff("SECOND", low, F.col("__from")) / step.total_seconds()
    held = held.withColumn("__piece", F.floor(passed).cast("int"))
    # The bounds stand as windows without a length.
    edges = objects.select("__key", F.lit(0).alias("__piece"), low.alias("__from"), low.alias("__to")).union(
        objects.select("__key", F.lit(pieces + 1).alias("__piece"), high.alias("__from"), high.alias("__to"))
    )
    held = held.select("__key", "__piece", "__from", "__to").union(edges)
    earlier = Window.partitionBy("__key").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    reach = held.groupBy("__key", "__piece").agg(F.max("__to").alias("__max"))
    reach = reach.select(F.col("__key").alias("__of"), F.col("__piece").alias("__at"), F.max("__max").over(earlier).alias("__carried"))
    joined = held.join(reach, F.col("__key").eqNullSafe(F.col("__of")) & (F.col("__piece") == F.col("__at")))
    inside = Window.partitionBy("__key", "__piece").orderBy("__from", "__to").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.max("__to").over(inside), "__carried")
    gaps = joined.withColumn("__covered", covered).where("__from > __covered")
    return gaps.select(F.col("__key").alias(key), F.col("__covered").alias("gap_start"), F.col("__from").alias("gap_end"))


def project_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Exactly the named columns; a name with dots is one name, a missing one fails."""
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.select(*[column(f) for f in fields])


def with_position(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """Add ``_position``, 0-based in the total order of ``order``; also gives the count.

    Range partitions are sorted apart and written once; only the rows per partition, one
    number each, meet in one place.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [column(c) for c in order]
    ranged = materialize(
        df.repartitionByRange(partitions, *by)
        .sortWithinPartitions(*by)
        .withColumn("__id", F.monotonically_increasing_id()),
        "positions",
    )
    part, within = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    starts, total = [], 0
    for row in sorted(sizes.collect()):
        starts.append((row["__part"], total))
        total += row["__rows"]
    offsets = df.sparkSession.createDataFrame(starts, "__part long, __start long")
    placed = ranged.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return placed.withColumn("_position", F.col("__start") + within).drop(
        "__id", "__part", "__start"
    ), total


def chunk(df: DataFrame, order: Sequence[str], size: int = CHUNK_SIZE) -> DataFrame:
    """Add ``_chunk``: ``ceil(n / size)`` contiguous parts in order, larger ones first (A5).

    Part sizes differ by one at most. No rows give no chunk. ``order`` must be total.
    """
    placed, total = with_position(df, order)
    chunks = max(1, -(-total // size))
    small, larger = divmod(total, chunks)
    edge = larger * (small + 1)
    position = F.col("_position")
    part = F.when(position < edge, F.floor(position / (small + 1))).otherwise(
        larger + F.floor((position - edge) / max(small, 1))
    )
    return placed.withColumn("_chunk", part.cast("long")).drop("_position")


def chunk_hash(df: DataFrame, key: Sequence[str], chunks: int) -> DataFrame:
    """Add ``_chunk`` from a hash of the key: near-equal parts without a sort (A5)."""
    return df.withColumn("_chunk", F.pmod(F.xxhash64(*[column(k) for k in key]), F.lit(chunks)))
