"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varve.llm.common import parts_for

NEAREST = 10
# Vectors that the rotation is learned from, at most; those of least hash are taken.
SAMPLE_ROWS = 20_000
ROTATIONS = 30
# Bits of a substring, each with a table of its own.
SUBSTRING = 8
# Vectors of one shard of the index, queries of one block that meets it, and queries worked out at once.
SHARD_ROWS, BLOCK_ROWS, QUERY_ROWS = 8192, 8192, 1024
# Candidates to retrieve for each query and shard before the radius stops growing.
ENOUGH = 400

SEED = 20_240_203


@dataclass
class Codes:
    """Mean and rotation; a code has a bit for each rotated direction."""

    mean: np.ndarray
    rotation: np.ndarray

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Substrings of the codes: vectors x tables, 8 bits each."""
        bits = (vectors - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1)


def learn_codes(sample: np.ndarray, dim: int) -> Codes:
    """Iterative quantisation: principal directions, then the rotation that brings them nearest to signs.

    There are as many bits as dimensions, in whole substrings.
    """
    rng = np.random.default_rng(SEED)
    bits = max(SUBSTRING, dim // SUBSTRING * SUBSTRING)
    if not len(sample):
        return Codes(np.zeros(dim), rng.normal(size=(dim, bits)))
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    main = vectors[:, ::-1][:, : min(bits, dim)]
    if bits > dim:
        main = np.concatenate([main, rng.normal(size=(dim, bits - dim))], axis=1)
    rotation, _ = np.linalg.qr(rng.normal(size=(bits, bits)))
    projected = centred @ main
    for _ in range(ROTATIONS):
        left, _, right = np.linalg.svd(projected.T @ np.sign(projected @ rotation))
        rotation = left @ right
    return Codes(mean, main @ rotation)


_MASKS = [np.flatnonzero(np.bitwise_count(np.arange(256)) == k).astype(np.uint8) for k in range(SUBSTRING + 1)]


class MultiIndex:
    """One table for each substring of the codes, and the search in all of them."""

    def __init__(self, codes: np.ndarray):
        self.rows, self.tables = codes.shape
        # A row for each table, so that the substrings of one table lie together.
        self.columns = np.ascontiguousarray(codes.T)
        # Rows by substring, one table after the other; size and first place of the rows of each substring.
        self.order = np.argsort(self.columns, axis=1, kind="stable").ravel()
        self.size = np.stack([np.bincount(c, minlength=256) for c in self.columns])
        self.first = (np.cumsum(self.size) - self.size.ravel()).reshape(self.size.shape)

    def probe(self, query: np.ndarray, flips: int) -> np.ndarray:
        """Rows that differ from the query in ``flips`` bits of a substring, once for each such substring."""
        table, value = np.arange(self.tables)[:, None], query[:, None] ^ _MASKS[flips]
        size, first = self.size[table, value].ravel(), self.first[table, value].ravel()
        ends = np.cumsum(size)
        return self.order[np.arange(ends[-1]) + np.repeat(first - (ends - size), size)]

    def search(self, query: np.ndarray, enough: int) -> np.ndarray:
        """Rows within the least radius that holds ``enough`` of them, or all rows.

        Pigeonhole: a code at most ``tables * (step + 1) - 1`` bits away differs in at most ``step``
        bits in one of its substrings, so probing each table for all substrings that near finds it. A
        step probes only for substrings that no step before it did, and a row is compared once.
        """
        met = np.zeros(self.rows, bool)
        distance = np.full(self.rows, SUBSTRING * self.tables + 1, np.int32)
        for step in range(SUBSTRING):
            before = met.copy()
            met[self.probe(query, step)] = True
            new = np.flatnonzero(met & ~before)
            bits = np.bitwise_count(np.take(self.columns, new, axis=1) ^ query[:, None])
            distance[new] = bits.sum(axis=0, dtype=np.int32)
            rows = np.flatnonzero(distance <= self.tables * (step + 1) - 1)
            if len(rows) >= min(enough, self.rows):
                return rows
        return np.arange(self.rows)


def _valid(column: str) -> Column:
    """Whether a vector takes part: no null, no non-finite component, not all zero, not empty."""
    v = F.col(column)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _matrix(column) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.ListArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _may_be_nearest(rows, vectors, squares, vector, nearest):
    """Those of ``rows`` that may be among the ``nearest`` by exact distance, by their products with ``vector``.

    A square of a distance is that of the row, less twice the product, and that of ``vector``, which is
    the same for all. ``slack`` is more than rounding can change here and in the distances that are
    compared in the end; what is not a number stays.
    """
    if len(rows) <= nearest:
        return rows
    own, floats = squares[rows], np.finfo(np.float64)
    about = own - 2 * (vectors[rows] @ vector)
    slack = 8 * (len(vector) + 4) * (floats.eps * (own + vector @ vector) + floats.tiny)
    far = np.partition(about + slack, nearest - 1)[nearest - 1]
    return rows[~(about - slack > far)]


def _best(query_ids, queries, ids, vectors, index, codes, nearest):
    """(query id, id, distance) of the nearest among what the index retrieves, by exact distance."""
    out = []
    with np.errstate(over="ignore", invalid="ignore"):
        squares = (vectors**2).sum(axis=1)
        for query_id, vector, code in zip(query_ids.tolist(), queries, codes.encode(queries)):
            rows = index.search(code, ENOUGH)
            rows = _may_be_nearest(rows[ids[rows] != query_id], vectors, squares, vector, nearest)
            distance = np.sqrt(((vectors[rows] - vector) ** 2).sum(axis=1))
            best = np.lexsort((ids[rows], distance))[:nearest]
            out.append((np.full(len(best), query_id), ids[rows[best]], distance[best]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def _likely_sample(base: DataFrame, rows: int) -> DataFrame:
    """Rows below the hash that a tenth more than the sample lie below, if ids are even."""
    share = 1.1 * SAMPLE_ROWS / rows
    return base if share >= 1 else base.where(F.xxhash64("id") < F.lit(int(share * 2**64) - 2**63))


def _sample(base: DataFrame, rows: int) -> np.ndarray:
    """The ``SAMPLE_ROWS`` vectors of least hash among ``rows``, in that order.

    Without a bound every partition would send as many rows as the whole sample has. Ids that come
    often may leave too few below it; then all rows are sought.
    """
    for some in (_likely_sample(base, rows), base):
        found = some.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").toPandas()["v"]
        if len(found) >= min(SAMPLE_ROWS, rows):
            break
    return np.stack(found.to_list()).astype(np.float64)


def _meetings(base: DataFrame, shards: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Vectors and queries, each dealt to the pairs (shard, block) that it takes part in.

    The vectors of a shard go to each block of queries, and the queries of a block to each shard.
    """

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    # A salt spreads rows that share an id, so a shard stays near its size whatever the ids.
    shard = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    held = base.select("id", "v", shard.alias("shard")).select("*", every(blocks).alias("block"))
    asked = base.where("asked").groupBy("id").agg(F.min("v").alias("v"))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    return held, asked.select("id", "v", every(shards).alias("shard"), block.alias("block"))


def nearest(vectors: DataFrame, queries: Column, id_column: str = "vec_id", column: str = "embedding", count: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds, its nearest other rows.

    Every row is in the index, which is cut into shards of bounded size by a hash of the id; the
    queries are cut into blocks alike, and a task holds one shard and one block. A shard retrieves all codes within a Hamming radius, which
    grows until it holds enough of them, and ranks these by the Euclidean distance of the original
    vectors, in double precision. Ties go to the smaller id. The best of all shards are merged.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    rows with a null id or with another length than the most common one (ties: the smaller). Rows
    that share a query's id are not its neighbours. Repeated rows are candidates each; a repeated
    query counts once. Other columns are ignored. Fewer candidates give fewer rows.
    """
    base = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{column}`").cast("array<double>").alias("v"),
        queries.alias("asked"),
    ).where(F.col("id").isNotNull() & _valid("v"))
    sizes = base.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("count"), F.count_if("asked").alias("asked"))
    sizes = sizes.orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return base.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    dim, rows = sizes[0]["d"], sizes[0]["count"]
    base = base.where(F.size("v") == dim)
    codes = learn_codes(_sample(base, rows), dim)
    held, asked = _meetings(base, parts_for(rows, SHARD_ROWS), parts_for(sizes[0]["asked"], BLOCK_ROWS))

    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if shard.num_rows and block.num_rows:
            held = _matrix(shard.column("v"))
            index = MultiIndex(codes.encode(held))
            ids = shard.column("id").to_numpy()
            parts = []
            for at in range(0, block.num_rows, QUERY_ROWS):
                some = block.slice(at, QUERY_ROWS)
                parts.append(_best(some.column("id").to_numpy(), _matrix(some.column("v")), ids, held, index, codes, count))
            found = [np.concatenate(x) for x in zip(*parts)]
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    each = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("query_id", "rank", "vec_id", "score")

