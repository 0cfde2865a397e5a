"""Which stored parts may hold known content: bitmaps over the places of their row hashes.

A load must know whether a row's content was ever seen before. Hashes have no order that a scan could
use, so without help it reads those of all history. A bitmap has a bit for each hash of a part, at a
place that follows from the hash; a part whose bitmaps share no bit with those of the new rows holds
none of their hashes and need not be opened. A shared bit may be chance, so the parts that are opened
are compared by whole hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.functions.columns import column
from varve.operators.versioning import ROW_HASH

# Bits of one bitmap, as Spark's bitmap functions have it.
BITS = 32_768
# Bits to a hash: by chance one new hash finds a bit of a part set once in so many times.
SPARSE = 64
# Bitmaps that one part may have; a larger part is less sparse.
MOST_BITMAPS = 1 << 15


def bitmaps_for(rows: int) -> int:
    """Bitmaps a part of ``rows`` hashes takes, a power of two."""
    wanted = -(-max(rows, 1) * SPARSE // BITS)
    return min(1 << max(wanted - 1, 0).bit_length(), MOST_BITMAPS)


def _place(row_hash: str, bitmaps: Column) -> Column:
    """Place of a hash among all bits of a part, from 0 on."""
    return F.pmod(F.xxhash64(column(row_hash)), bitmaps.cast("long") * BITS)


def content_bitmaps(rows: DataFrame, by: Sequence[str], bitmaps: int, row_hash: str = ROW_HASH) -> DataFrame:
    """(``by``, ``bitmaps``, ``slot``, ``bits``): which places the hashes of each part take.

    One row a part and stretch of ``BITS`` places that is not empty, of 4 KB at most; sparse ones
    compress well. ``bitmaps`` is their number in a part. Null hashes have no place.
    """
    place = _place(row_hash, F.lit(bitmaps))
    placed = rows.where(column(row_hash).isNotNull()).select(*[column(b) for b in by], place.alias("__place"))
    slot = F.floor(F.col("__place") / BITS).cast("int").alias("slot")
    bits = F.bitmap_construct_agg(F.pmod("__place", F.lit(BITS))).alias("bits")
    return placed.groupBy(*[column(b) for b in by], slot).agg(bits).select(*[column(b) for b in by], F.lit(bitmaps).alias("bitmaps"), "slot", "bits")


def may_hold(index: DataFrame, by: Sequence[str], new: DataFrame, row_hash: str = ROW_HASH) -> DataFrame:
    """The parts, by the columns ``by``, that may hold the hash of a row of ``new``; all that do are among them.

    The new rows are turned to bitmaps of every size the index has, powers of two and so a handful, and
    what meets the index is a bitmap a stretch, however many rows are new.
    """
    sizes = sorted(r["bitmaps"] for r in index.select("bitmaps").distinct().collect())
    places = new.where(column(row_hash).isNotNull()).select(column(row_hash).alias("__hash")).distinct()
    each = F.explode(F.array(*map(F.lit, sizes)) if sizes else F.array().cast("array<int>")).alias("bitmaps")
    placed = places.select("__hash", each).withColumn("__place", _place("__hash", F.col("bitmaps")))
    sought = placed.groupBy("bitmaps", F.floor(F.col("__place") / BITS).cast("int").alias("slot")).agg(
        F.bitmap_construct_agg(F.pmod("__place", F.lit(BITS))).alias("sought")
    )
    met = index.join(sought, ["bitmaps", "slot"]).select(*[column(b) for b in by], "slot", F.explode(F.array("bits", "sought")).alias("bits"))
    shared = met.groupBy(*[column(b) for b in by], "slot").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("shared"))
    return shared.where("shared > 0").select(*[column(b) for b in by]).distinct()
