"""Centroid clustering with exact scalar products that are kept and updated by what changed."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.vectors import lists, matrix, partial_sums, products, staged_integers
from varve.session import discard, staged

CLUSTERS, ROUNDS, SCALE, DIMS, SEED = 16, 3, 64, 64, 1

_STATE = "ints array<long>, dots array<long>, cluster int, distance long"


@dataclass
class Clusters:
    """``centroids`` is clusters x dims; ``members`` and ``inertia`` say what each holds at the end."""

    centroids: np.ndarray
    members: list[int]
    inertia: list[int]
    changed: list[int]

    def texts(self) -> list[str]:
        """The components of each centroid in decimal."""
        return [",".join(map(str, c)) for c in self.centroids.tolist()]


def _assigned(rows: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid by the kept products, the smaller number on a tie, and the squared distance."""
    beyond = (centroids * centroids).sum(axis=1) - 2 * dots
    best = beyond.argmin(axis=1)
    return best, beyond[np.arange(len(rows)), best] + (rows * rows).sum(axis=1)


def _state(table: DataFrame, keep: list[str], centroids: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """The vectors with their products, cluster and distance; products are new, or ``before``'s brought up to date.

    Of a centroid only the components that differ from ``before`` are multiplied.
    """
    dims, count = centroids.shape[1], len(centroids)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.select(*keep).schema)
    change = None if before is None else centroids - before

    def run(batches):
        for batch in batches:
            rows = matrix(batch.column(len(keep)), dims)
            if change is None:
                dots = products(rows, centroids)
            else:
                dots = matrix(batch.column(len(keep) + 1), count)
                for k in range(count):
                    places = np.flatnonzero(change[k])
                    if len(places):
                        dots[:, k] += products(rows[:, places], change[k : k + 1, places])[:, 0]
            cluster, distance = _assigned(rows, dots, centroids)
            made = [*batch.columns[: len(keep)], batch.column(len(keep)), lists(dots), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=[*keep, "ints", "dots", "cluster", "distance"])

    read = [*keep, "ints"] if before is None else [*keep, "ints", "dots"]
    return table.select(*read).mapInArrow(run, f"{fields}, {_STATE}")


def _updated(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids as the floor of the mean of their vectors; an empty one stays."""

    def keyed(batch):
        return batch.column(0).to_numpy(), matrix(batch.column(1), centroids.shape[1])

    new = centroids.copy()
    for group, rows, sums in partial_sums(state.select("cluster", "ints"), *centroids.shape, keyed):
        new[group] = np.array(sums, np.int64) // rows
    return new


def cluster(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding",
    scale: int = SCALE, dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
) -> tuple[DataFrame, Clusters]:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector, and the clusters.

    Components become floors of ``scale`` times their value. The vectors whose ``seed:id`` has the
    least sha256 are the first centroids. Every vector keeps its exact scalar products with all
    centroids in a table of its own; a round replaces each centroid by the floor of its vectors' mean,
    and brings the products up to date by the components of each centroid that changed. The vectors
    themselves never move: a round reads and writes each once where it lies, and shuffles one row of
    sums a task and cluster. Rounds end early when no centroid changes.

    Vectors that are null, have another length than ``dims`` or hold null or non-finite components give
    no row; components beyond exact 64-bit distances raise ValueError. A null id counts as empty text
    in the hash; of equal ids the lesser vectors come first. Repeated rows stay rows each, ties go to
    the smaller number, fewer vectors than ``clusters`` make fewer clusters, an empty table gives no
    rows, and other columns are ignored, whatever their names.
    """
    spark, keep = vectors.sparkSession, {"__id": F.col(f"`{id_column}`")}
    table, path, rows, _ = staged_integers(vectors, keep, column, scale, dims)
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__id").cast("string"), F.lit(""))), 256)
    first = table.select(place.alias("place"), "ints").orderBy("place", "ints").limit(clusters).collect()
    centroids = np.array([r["ints"] for r in first], np.int64).reshape(len(first), dims)
    if not rows:
        none = Clusters(centroids, [], [], [])
        return _described(table.withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")}), id_column, none), none
    state, held = staged(_state(table, list(keep), centroids, None), "products")
    discard(spark, path)
    changed = []
    for _ in range(rounds):
        new = _updated(state, centroids)
        changed.append(int((new != centroids).sum()))
        if not changed[-1]:
            break
        state, path = staged(_state(state, list(keep), new, centroids), "products")
        discard(spark, held)
        centroids, held = new, path
    ends = {r["cluster"]: r for r in state.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("distance").alias("inertia")).collect()}
    members = [ends[k]["rows"] if k in ends else 0 for k in range(len(centroids))]
    inertia = [ends[k]["inertia"] if k in ends else 0 for k in range(len(centroids))]
    found = Clusters(centroids, members, inertia, changed)
    return _described(state, id_column, found), found


def _described(state: DataFrame, id_column: str, found: Clusters) -> DataFrame:
    """The rows of the state with what is known of their cluster, out of arrays of a clusters' length."""

    def of(values: list, kind: str):
        return F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster") + 1) if values else F.lit(None).cast(kind)

    return state.select(
        F.col("__id").alias(id_column),
        "cluster",
        "distance",
        of(found.inertia, "long").alias("cluster_inertia"),
        F.lit(sum(found.inertia)).cast("long").alias("inertia"),
        F.sha2(of(found.texts() if found.inertia else [], "string"), 256).alias("centroid_sha256"),
    )
