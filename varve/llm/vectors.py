"""What the exact operators on vectors share: which rows take part, and their integer components."""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from varve.session import staged

# Whole numbers up to here are exact in double precision.
EXACT = 1 << 53


def finite(column: Column) -> Column:
    """Whether a vector is there and every component is a finite number."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return column.isNotNull() & F.coalesce(fine, F.lit(False))


def staged_integers(vectors: DataFrame, keep: dict[str, Column], column: str, scale: int, dims: int) -> tuple[DataFrame, str, int, int]:
    """Kept columns and ``ints``, the floors of ``scale`` times each component, written once.

    Rows whose vector is null, has another length than ``dims``, or holds null or non-finite
    components go. Returns the table, its folder, its rows and the largest size of a component.
    Squared distances are whole 64-bit numbers; components so large that one could overflow raise
    ValueError.
    """
    v = F.col(f"`{column}`").cast("array<double>")
    chosen = vectors.select(*[c.alias(n) for n, c in keep.items()], v.alias("ints"))
    chosen = chosen.where((F.size("ints") == dims) & finite(F.col("ints")))
    scaled = chosen.withColumn("ints", F.transform("ints", lambda x: F.floor(x * F.lit(float(scale)))))
    largest = F.max(F.array_max(F.transform("ints", lambda x: F.abs(x.cast("double")))))
    seen = Observation()
    table, path = staged(scaled.observe(seen, F.count("*").alias("rows"), largest.alias("largest")), "integer-vectors")
    most = seen.get["largest"] or 0.0
    limit = isqrt((1 << 62) // dims) // 2
    if most > limit:
        raise ValueError(f"components reach {most:.0f} in whole steps; distances are exact to {limit}")
    return table, path, seen.get["rows"], int(most)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as rows x width whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def lists(rows: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as a list column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).reshape(-1), pa.int64()))


def products(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact scalar products, rows x others. Doubles carry them where all sums stay exact."""
    if not rows.size or not others.size:
        return np.zeros((len(rows), len(others)), np.int64)
    bound = int(np.abs(rows).max()) * int(np.abs(others).max()) * rows.shape[1]
    if bound < EXACT:
        return (rows.astype(np.float64) @ others.T.astype(np.float64)).astype(np.int64)
    return rows @ others.T


def group_sums(keys: np.ndarray, rows: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and componentwise sums of each of ``groups`` groups."""
    sums = np.zeros((groups, rows.shape[1]), np.int64)
    np.add.at(sums, keys, rows)
    return np.bincount(keys, minlength=groups).astype(np.int64), sums


def partial_sums(df: DataFrame, groups: int, width: int, keyed) -> list:
    """(group, rows, sums) of all non-empty groups; every task adds its rows up before the shuffle.

    ``keyed(batch)`` gives the group numbers and the matrix of an Arrow batch. The result has at
    most ``groups`` rows, which is a parameter of the caller and not of the data.
    """

    def run(batches):
        rows, sums = np.zeros(groups, np.int64), np.zeros((groups, width), np.int64)
        for batch in batches:
            if batch.num_rows:
                more = group_sums(*keyed(batch), groups)
                rows, sums = rows + more[0], sums + more[1]
        held = np.flatnonzero(rows)
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(rows[held]), lists(sums[held])], names=["group", "rows", "sums"])

    parts = df.mapInArrow(run, "group long, rows long, sums array<long>")
    total = parts.groupBy("group").agg(F.sum("rows").alias("rows"), F.array(*[F.sum(F.col("sums")[n]) for n in range(width)]).alias("sums"))
    return total.collect()
