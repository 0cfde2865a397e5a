"""Vector code compression: product codebooks by Lloyd rounds over parts that stay with their entry."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.common import parts_for
from varve.llm.vectors import lists, matrix, partial_sums, products, staged_integers
from varve.session import broadcast_if_small, discard, materialize_counted, staged

PARTS, ENTRIES, ROUNDS, SCALE, DIMS = 4, 256, 4, 1024, 64
# Parts that one owner, a (position, entry, salt), holds at most, but for uneven dealing; and the least salts.
OWNER_ROWS, SALTS = 100_000, 8
# Parts compared with a codebook at once.
STEP = 4096

_MEMBER = "position int, entry int, salt int, part array<long>"


@dataclass
class Codebooks:
    """``entries[position]`` is entries x width; ``moved`` counts the parts that changed entry in each round."""

    entries: np.ndarray
    moved: list[int] = field(default_factory=list)

    @property
    def parts(self) -> int:
        return len(self.entries)

    @property
    def width(self) -> int:
        return self.entries.shape[2]

    def text(self) -> str:
        """All components in decimal, by part, entry and place."""
        return ",".join(map(str, self.entries.reshape(-1).tolist()))


def nearest_entries(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row, the lower on a tie, and its squared distance."""
    index, distance = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    own = (book * book).sum(axis=1)
    for at in range(0, len(rows), STEP):
        some = rows[at : at + STEP]
        beyond = own - 2 * products(some, book)
        best = beyond.argmin(axis=1)
        index[at : at + STEP] = best
        distance[at : at + STEP] = beyond[np.arange(len(some)), best] + (some * some).sum(axis=1)
    return index, distance


def _first_books(table: DataFrame, id_column: str, parts: int, entries: int, dims: int) -> np.ndarray:
    """Codebooks made of the vectors of least id (nulls last; of equal ids the lesser vectors)."""
    first = table.orderBy(F.col(id_column).asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    rows = np.array([r["ints"] for r in first], np.int64).reshape(len(first), parts, dims // parts)
    return np.ascontiguousarray(rows.transpose(1, 0, 2))


def _members(table: DataFrame, books: np.ndarray, salts: int) -> DataFrame:
    """Every part of every vector as a row, with the nearest entry of its position."""
    parts, _, width = books.shape

    def run(batches):
        at = TaskContext.get().partitionId()
        for batch in batches:
            cut = matrix(batch.column(0), parts * width).reshape(-1, parts, width)
            salt = pa.array((at + np.arange(len(cut))) % salts, pa.int32())
            at += len(cut)
            for position in range(parts):
                index, _ = nearest_entries(cut[:, position], books[position])
                where = pa.array(np.full(len(cut), position), pa.int32())
                yield pa.RecordBatch.from_arrays([where, pa.array(index, pa.int32()), salt, lists(cut[:, position])], names=["position", "entry", "salt", "part"])

    return table.select("ints").mapInArrow(run, _MEMBER)


def _reassigned(members: DataFrame, books: np.ndarray) -> DataFrame:
    """The members with the entry that is nearest now, and whether it is another than before."""
    width = books.shape[2]

    def run(batches):
        for batch in batches:
            position, entry = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows, now = matrix(batch.column(3), width), np.zeros(batch.num_rows, np.int64)
            for p in np.unique(position):
                held = position == p
                now[held] = nearest_entries(rows[held], books[p])[0]
            made = [batch.column(0), pa.array(now, pa.int32()), batch.column(2), batch.column(3), pa.array(now != entry)]
            yield pa.RecordBatch.from_arrays(made, names=["position", "entry", "salt", "part", "moved"])

    return members.mapInArrow(run, _MEMBER + ", moved boolean")


def _updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries as the floor of the mean of their members; an entry without members stays."""
    parts, entries, width = books.shape

    def keyed(batch):
        return batch.column(0).to_numpy() * entries + batch.column(1).to_numpy(), matrix(batch.column(3), width)

    new = books.copy()
    for group, rows, sums in partial_sums(members.select("position", "entry", "salt", "part"), parts * entries, width, keyed):
        new[group // entries, group % entries] = np.array(sums, np.int64) // rows
    return new


def learn_codebooks(
    table: DataFrame, rows: int, id_column: str, dims: int = DIMS, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks of a table of integer vectors (``ints``), after ``rounds`` of Lloyd's iteration.

    Each part is a member of its nearest entry and lies with that entry's owner, a (position, entry,
    salt), in the files of one task; the salt deals the members of a popular entry to several owners,
    by the number of rows alone. A round adds up the members where they lie, gives every owner the
    new codebooks (of a size set by the parameters), and splits its members: those that keep their
    entry are written on without a shuffle, and only those that changed it are shuffled, to their new
    owners. A round that moves none ends the iteration, as nothing could change any more.

    Repeated rows are members each. With fewer vectors than entries, the books are shorter; without
    any they are empty.
    """
    if dims % parts:
        raise ValueError(f"{dims} components cannot be cut into {parts} equal parts")
    books = Codebooks(_first_books(table, id_column, parts, entries, dims))
    if not rows or not rounds:
        return books
    spark = table.sparkSession
    salts, owners = max(SALTS, parts_for(rows, OWNER_ROWS)), parts_for(rows * parts, OWNER_ROWS)

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(owners, "position", "entry", "salt")

    members, held = staged(dealt(_members(table, books.entries, salts)), "members")
    folders = [held]
    for n in range(rounds):
        new = _updated(members, books.entries)
        if np.array_equal(new, books.entries):
            break
        books.entries = new
        if n == rounds - 1:
            break
        split, kept = staged(_reassigned(members, new), "members", "moved")
        arrivals, came = staged(dealt(split.where("moved").drop("moved")), "arrivals")
        books.moved.append(arrivals.count())
        members = split.where(~F.col("moved")).drop("moved").unionByName(arrivals)
        discard(spark, *folders)
        folders = [kept, came]
    discard(spark, *folders)
    return books


def encode(table: DataFrame, keep: list[str], books: Codebooks) -> DataFrame:
    """``keep``, the code (two hex digits a part, in part order) and the squared error of each vector."""
    entries, parts, width = books.entries, books.parts, books.width
    kept = table.select(*[f"`{c}`" for c in keep])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(batches):
        for batch in batches:
            cut = matrix(batch.column(batch.num_columns - 1), parts * width).reshape(-1, parts, width)
            found = [nearest_entries(cut[:, p], entries[p]) for p in range(parts)]
            codes = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            text = [bytes(row).hex() for row in codes]
            error = np.sum([d for _, d in found], axis=0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(text, pa.string()), pa.array(error, pa.int64())], names=[*keep, "code", "error"])

    return table.select(*[f"`{c}`" for c in keep], "ints").mapInArrow(run, f"{fields}, code string, error long")


def decode(coded: DataFrame, books: Codebooks, code: str = "code", out: str = "ints") -> DataFrame:
    """The vector that each code stands for, in whole steps, as another column."""
    table = F.array(*[F.array(*[F.array(*map(F.lit, e)) for e in book.tolist()]) for book in books.entries])

    def part(p: int):
        return F.element_at(F.element_at(table, p + 1), F.conv(F.substring(f"`{code}`", 2 * p + 1, 2), 16, 10).cast("int") + 1)

    return coded.withColumn(out, F.concat(*[part(p) for p in range(books.parts)]))


def compress(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", label: str = "label",
    scale: int = SCALE, dims: int = DIMS, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """(id, code, error, label_error) of every vector that takes part, and the codebooks.

    Components become floors of ``scale`` times their value; codes are by :func:`learn_codebooks` and
    :func:`encode`, at most 256 entries. ``label_error`` is the error summed over the rows of an equal
    label, nulls being one label.

    Vectors that are null, hold null or non-finite components, or have another length than ``dims``
    give no row; components beyond exact 64-bit distances raise ValueError. Null ids come last when the
    first codebooks are chosen. Repeated rows and ids stay rows each, ties go to the lower entry, an
    empty table gives no rows, and other columns are ignored, whatever their names.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits a part, so at most 256 entries")
    keep = {"__id": F.col(f"`{id_column}`"), "__label": F.col(f"`{label}`")}
    table, path, rows, _ = staged_integers(vectors, keep, column, scale, dims)
    books = learn_codebooks(table, rows, "__id", dims, parts, entries, rounds)
    if rows:
        coded, _ = materialize_counted(encode(table, list(keep), books), "codes")
    else:
        coded = table.select("__id", "__label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    sums, count = materialize_counted(coded.groupBy("__label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = broadcast_if_small(sums.withColumnRenamed("__label", "__of"), count["rows"])
    joined = coded.join(sums, F.col("__label").eqNullSafe(F.col("__of")))
    if rows:
        discard(vectors.sparkSession, path)
    return joined.select(F.col("__id").alias(id_column), "code", "error", "label_error"), books
