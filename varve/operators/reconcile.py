"""Two tables that should hold the same rows: where they do not, by a tree of digests (Q1).

A row falls into a leaf by its hash. A leaf's digest is the number of its rows and sums of their
hashes, which do not depend on order, so that equal multisets of rows have equal digests however they
are stored; the digest of a node is the sum of its children's. The trees are compared from the root
down, and only rows of leaves that differ are shuffled and compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.functions.columns import column
from varve.session import BROADCAST_ROWS, materialize

# Leaves are named by so many bits of a row's hash, and nodes of the levels above by fewer.
LEVELS = (0, 6, 12)
_SUMS = ("rows", "low", "high", "more")


def _leaf(columns: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*[column(c) for c in columns]), 64 - bits)


def leaf_digests(df: DataFrame, columns: Sequence[str] | None = None, bits: int = LEVELS[-1]) -> DataFrame:
    """(leaf, rows, low, high, more): the digest of every leaf that has rows.

    ``low``, ``high`` and ``more`` add up 32 bits each of two 64-bit hashes, so a sum is exact for two
    billion rows a leaf. A side that is far away or seldom read can keep these instead of its rows.
    """
    names = list(columns or df.columns)
    # Two hashes of one row must not follow from one another.
    one, two = F.xxhash64(*map(column, names)), F.xxhash64(F.lit(7), *map(column, names))
    half = 0xFFFFFFFF
    return df.groupBy(_leaf(names, bits).alias("leaf")).agg(
        F.count("*").alias("rows"),
        F.sum(one.bitwiseAND(half)).alias("low"),
        F.sum(F.shiftrightunsigned(two, 32)).alias("high"),
        F.sum(two.bitwiseAND(half)).alias("more"),
    )


def differing_leaves(left: DataFrame, right: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """(leaf) of the leaves whose digests differ, found from the root down.

    Both are :func:`leaf_digests`. A level looks at the children of nodes that differ only, so equal
    tables are done after the root.
    """
    bits = levels[-1]
    sides = left.select("leaf", *_SUMS).union(right.select("leaf", *[(-F.col(s)).alias(s) for s in _SUMS]))
    for above, level in zip((None, *levels), levels):
        node = F.shiftright("leaf", bits - level)
        sums = sides.groupBy(node.alias("node")).agg(*[F.sum(s).alias(s) for s in _SUMS])
        uneven = sums.where(" OR ".join(f"{s} <> 0" for s in _SUMS)).select("node")
        if level == bits:
            return uneven.select(F.col("node").alias("leaf"))
        nodes = [r["node"] for r in uneven.collect()] if 1 << level <= BROADCAST_ROWS else None
        if nodes == []:
            return uneven.select(F.col("node").alias("leaf"))
        if nodes is not None:
            sides = sides.where(node.isin(nodes))
    raise ValueError("no levels")


def row_differences(left: DataFrame, right: DataFrame, levels: Sequence[int] = LEVELS, names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """The rows that one table has more often than the other: ``side``, the columns, ``copies``.

    Rows are equal when all columns are, nulls and NaN being equal to themselves; columns go by the names
    of ``left`` and both must have the same. ``copies`` says how many more there are. Rows of leaves that
    agree are scanned but not shuffled. Map columns cannot be compared.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"different columns: {sorted(set(left.columns) ^ set(right.columns))}")
    columns, bits = left.columns, levels[-1]
    right = right.select(*[column(c).cast(left.schema[c].dataType).alias(c) for c in columns])
    digests = [materialize(leaf_digests(side, columns, bits), "digests") for side in (left, right)]
    # At most 2 ** bits rows of eight bytes.
    leaves = [r["leaf"] for r in differing_leaves(*digests, levels).collect()]

    def signed(side: DataFrame, sign: int) -> DataFrame:
        return side.where(_leaf(columns, bits).isin(leaves)).select("*", F.lit(sign).alias("__sign"))

    both = signed(left, 1).unionByName(signed(right, -1))
    surplus = both.groupBy(*map(column, columns)).agg(F.sum("__sign").alias("__more")).where("__more <> 0")
    side = F.when(F.col("__more") > 0, names[0]).otherwise(names[1])
    return surplus.select(side.alias("side"), *map(column, columns), F.abs("__more").alias("copies"))
