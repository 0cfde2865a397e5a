"""CSV whose quoted values hold line breaks, read in blocks by many tasks (S3).

A block of a file is read from its first line break on, and whether that lies inside a quoted value
is known only from all text before it. So a first pass works out, for each block, how it ends if it
starts outside quotes and if it starts inside. These maps of two states are put together from the
start of each file on, which tells every block's true state, and a second pass cuts the blocks into
records. A record that crosses blocks is put together from its pieces. A file that is one block starts
outside quotes and has no such record, so it is read by the second pass alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of a file that one task reads.
BLOCK_BYTES = 64 << 20
# A value whose quote is not closed within so many bytes is taken for a broken file.
RECORD_BYTES = 1 << 30

LINE = "value binary, path string, block long"
PIECE = "path string, owner long, block long, first boolean, whole boolean, text binary"


@dataclass(frozen=True)
class Dialect:
    """The three characters that shape a CSV file."""

    separator: str = ","
    quote: str = '"'
    escape: str = "\\"

    def scanner(self) -> Scanner:
        return Scanner(self)


class Scanner:
    """Tells whether a quoted value is open at the end of a line, given whether one was at its start."""

    def __init__(self, dialect: Dialect) -> None:
        separator, quote, escape = (re.escape(c.encode()) for c in (dialect.separator, dialect.quote, dialect.escape))
        if dialect.escape == dialect.quote:
            body = rb"(?:[^%b]|%b%b)*+" % (quote, quote, quote)
        else:
            body = rb"(?:[^%b%b]|%b[%b%b]?)*+" % (quote, escape, escape, quote, escape)
        closed = rb"%b%b%b[^%b]*+" % (quote, body, quote, separator)
        plain = rb"[^%b%b][^%b]*+" % (quote, separator, separator)
        self._quote = dialect.quote.encode()
        # Whole fields, each with the separator after it; what is left is the last field.
        self._fields = re.compile(rb"(?:(?:%b|%b|)%b)*+" % (closed, plain, separator), re.S)
        self._closed = re.compile(closed, re.S)

    def open_after(self, line: bytes, inside: bool) -> bool:
        if self._quote not in line:
            return inside
        if inside:
            # As if the value began with this line.
            line = self._quote + line
        at = self._fields.match(line).end()
        return line.startswith(self._quote, at) and not self._closed.match(line, at)


def block_files(spark: SparkSession, paths: Sequence[str], block_bytes: int) -> DataFrame:
    """The files as text, in blocks that are the same whenever they are read, and whichever of them are.

    Spark sizes splits by the cores it has at that moment. A session that shares this one's context,
    with settings of its own, keeps them at ``block_bytes`` whatever the cluster does between passes.
    """
    side = spark.newSession()
    side.conf.set("spark.sql.files.maxPartitionBytes", str(block_bytes))
    side.conf.set("spark.sql.files.minPartitionNum", "1")
    # A most number of splits would make them larger, by the size of all files that are read.
    side.conf.unset("spark.sql.files.maxPartitionNum")
    return side.read.option("lineSep", "\n").text(list(paths))


def longer_files(files: DataFrame, block_bytes: int) -> DataFrame:
    """Those of :func:`block_files` that have more than a block; Spark opens no other ones."""
    return files.where(F.col("_metadata.file_size") > block_bytes)


def block_lines(spark: SparkSession, paths: Sequence[str], block_bytes: int) -> DataFrame:
    """(value, path, block) of every line, in blocks that are the same whenever they are read."""
    return lines_of(spark, block_files(spark, paths, block_bytes))


def lines_of(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(value, path, block) of every line of :func:`block_files`."""
    lines = files.select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    # What follows runs under the caller's session.
    return spark.createDataFrame([], LINE).union(lines)


def _runs(batches) -> Iterator[tuple[str, int, list[bytes]]]:
    """(path, block, lines) of the stretches of lines that are of one block, in order."""
    for batch in batches:
        paths, blocks = batch.column(1), batch.column(2).to_numpy()
        if not len(blocks):
            continue
        codes = paths.dictionary_encode().indices.to_numpy()
        new = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(codes) != 0)) + 1
        for i, j in zip(np.append(0, new), np.append(new, len(blocks))):
            yield paths[int(i)].as_py(), int(blocks[i]), batch.column(0).slice(i, j - i).to_pylist()


def block_maps(lines: DataFrame, dialect: Dialect) -> DataFrame:
    """(path, block, ends, starts): what each block does from either state.

    ``ends`` has bit 1 if a value is open at its end when none was at its start, bit 2 if one is when
    one was; ``starts`` likewise tells whether a record begins in the block. ``crlf`` is true where the
    first line of a file ends with a carriage return.
    """

    def run(batches):
        scanner, held = dialect.scanner(), None
        for path, block, rows in _runs(batches):
            if held is None or held[:2] != [path, block]:
                if held:
                    yield _map_row(held)
                held = [path, block, [False, True], [False, False], block == 0 and rows[0].endswith(b"\r")]
            ends, starts = held[2], held[3]
            for line in rows:
                for state in (0, 1):
                    starts[state] = starts[state] or not ends[state]
                if dialect.quote.encode() not in line:
                    continue
                if ends[0] == ends[1]:
                    ends[0] = ends[1] = scanner.open_after(line, ends[0])
                else:
                    ends[:] = [scanner.open_after(line, inside) for inside in ends]
        if held:
            yield _map_row(held)

    return lines.mapInArrow(run, "path string, block long, ends int, starts int, crlf boolean")


def _map_row(held) -> pa.RecordBatch:
    path, block, ends, starts, crlf = held
    bits = [pa.array([x[0] + 2 * x[1]], pa.int32()) for x in (ends, starts)]
    return pa.RecordBatch.from_arrays(
        [pa.array([path]), pa.array([block], pa.int64()), *bits, pa.array([crlf])], names=["path", "block", "ends", "starts", "crlf"]
    )


@dataclass
class Blocks:
    """Of the files of several blocks: where these lie, which start inside a quoted value, the block in
    which the record began that a block starts with, and whether lines end with carriage returns.
    Seventeen bytes a block."""

    known: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, bool]]

    @staticmethod
    def combine(maps: pd.DataFrame, record_bytes: int = RECORD_BYTES) -> Blocks:
        """Put the maps of each file's blocks together in order, from outside quotes at its start."""
        known = {}
        for path, rows in maps.sort_values(["path", "block"]).groupby("path", sort=False):
            if len(rows) == 1:
                continue
            inside, owner, states, owners = False, 0, [], []
            for block, ends, starts in zip(rows["block"].tolist(), rows["ends"].tolist(), rows["starts"].tolist()):
                if inside and block - owner > record_bytes:
                    raise ValueError(f"a value in {path!r} that begins after byte {owner} is not closed within {record_bytes} bytes")
                states.append(inside)
                owners.append(owner)
                if starts >> inside & 1:
                    owner = block
                inside = bool(ends >> inside & 1)
            known[path] = (rows["block"].to_numpy(np.int64), np.array(states), np.array(owners, np.int64), bool(rows["crlf"].any()))
        return Blocks(known)

    def start(self, path: str, block: int, first: bytes) -> tuple[bool, int, bool]:
        """Of a block and its first line: whether it starts inside a value, the block its first piece
        belongs to, and whether the file's lines end with carriage returns."""
        if path not in self.known:
            if block == 0:
                return False, 0, first.endswith(b"\r")
        else:
            starts, states, owners, crlf = self.known[path]
            at = int(np.searchsorted(starts, block))
            if at < len(starts) and starts[at] == block:
                return bool(states[at]), int(owners[at]), crlf
        raise RuntimeError(f"{path!r} has another block at {block} than when its quotes were scanned; has it changed?")

    def crossed(self) -> bool:
        """Whether a value is open where a block starts, so that a record crosses blocks."""
        return any(states.any() for _, states, _, _ in self.known.values())


class _Cutter:
    """Cuts the lines of one block into records and the pieces of records that cross its ends."""

    def __init__(self, scanner: Scanner, path: str, block: int, inside: bool, owner: int, crlf: bool) -> None:
        self.scanner, self.path, self.block, self.crlf = scanner, path, block, crlf
        self.open, self.whole, self.owner = inside, not inside, owner if inside else block
        self.first, self.held, self.made = block == 0, [], []

    def add(self, line: bytes) -> None:
        if self.crlf and line.endswith(b"\r"):
            line = line[:-1]
        if self.first and not self.held:
            line = line.removeprefix(b"\xef\xbb\xbf")
        if self.whole and not self.held and not line:
            return
        self.held.append(line)
        self.open = self.scanner.open_after(line, self.open)
        if not self.open:
            self._close(self.whole)

    def _close(self, whole: bool) -> None:
        self.made.append((self.path, self.owner, self.block, self.first, whole, b"\n".join(self.held)))
        self.owner, self.whole, self.first, self.held = self.block, True, False, []

    def end(self, only: bool) -> None:
        """``only`` says that its file has no other block, so that a value left open ends here."""
        if self.held:
            self._close(only)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.made:
            columns = [pa.array(c, t) for c, t in zip(zip(*self.made), _PIECE_TYPES)]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "owner", "block", "first", "whole", "text"])
            self.made = []


_PIECE_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]


def pieces(lines: DataFrame, blocks: Blocks, dialect: Dialect) -> DataFrame:
    """Records that lie in one block, and the pieces of those that cross blocks.

    ``first`` marks the first record of its file that is not empty. ``owner`` is the block where a
    record begins.
    """

    def run(batches):
        scanner, cutter = dialect.scanner(), None
        for path, block, rows in _runs(batches):
            if cutter is None or (cutter.path, cutter.block) != (path, block):
                if cutter:
                    cutter.end(cutter.path not in blocks.known)
                    yield from cutter.rows()
                cutter = _Cutter(scanner, path, block, *blocks.start(path, block, rows[0]))
            for line in rows:
                cutter.add(line)
            yield from cutter.rows()
        if cutter:
            cutter.end(cutter.path not in blocks.known)
            yield from cutter.rows()

    return lines.mapInArrow(run, PIECE)


def read_records(
    spark: SparkSession, paths: str | Sequence[str], dialect: Dialect = Dialect(), block_bytes: int = BLOCK_BYTES, record_bytes: int = RECORD_BYTES
) -> DataFrame:
    """(path, first, record): the text of every record, line breaks inside quotes kept.

    ``first`` is true for the first record of each file, its header. Empty lines between records
    are left out. Where the first line of a file ends with a carriage return, those before all line
    breaks go. A quote that is never closed makes one record of the rest of its file; beyond
    ``record_bytes`` that fails. The maps of all blocks, some bytes each, go through the driver.

    Files of one block are read once. Longer ones are read for their maps, then for their records, and,
    if a record of one crosses blocks, for the pieces of such records.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = block_files(spark, paths, block_bytes)
    longer = lines_of(spark, longer_files(files, block_bytes))
    blocks = Blocks.combine(block_maps(longer, dialect).toPandas(), record_bytes)
    cut = pieces(lines_of(spark, files), blocks, dialect)
    if not blocks.crossed():
        return _as_text(cut.select("path", "first", "text"))
    whole = cut.where("whole").select("path", "first", "text")
    crossing = pieces(longer, blocks, dialect).where("NOT whole").groupBy("path", "owner").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts")
    )
    joined = F.aggregate(F.slice("parts", 2, F.size("parts")), F.col("parts")[0]["text"], lambda a, p: F.concat(a, F.lit(b"\n"), p["text"]))
    return _as_text(whole.union(crossing.select("path", "first", joined.alias("text"))))


def _as_text(records: DataFrame) -> DataFrame:
    return records.select("path", "first", F.col("text").cast("string").alias("record"))


def parse_records(records: DataFrame, fields: T.StructType, options: dict[str, str], check_header: bool, keep: Sequence[Column] = ()) -> DataFrame:
    """The records that are no headers as columns; a header with other names fails.

    ``fields`` may have ``_corrupt_record``, which takes the text of a record that does not fit.
    """
    names = [f.name for f in fields if f.name != "_corrupt_record"]
    header = T.StructType([T.StructField(f"h{n}", T.StringType()) for n in range(len(names) + 1)])
    read = F.from_csv("record", header.simpleString()[7:-1].replace(":", " "), options)
    found = [read[f"h{n}"].eqNullSafe(F.lit(name)) for n, name in enumerate([*names, None])]
    wrong = F.raise_error(F.concat(F.lit("the header of "), F.col("path"), F.lit(f" is not {names}, but "), F.col("record")))
    is_row = ~F.col("first")
    if check_header:
        same = reduce(lambda a, b: a & b, found)
        is_row = F.when(is_row, True).when(same, False).otherwise(wrong.cast("boolean"))
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
    parsed = records.where(is_row).select(F.from_csv("record", ddl, options).alias("__row"), *keep)
    return parsed.select(*[F.col("__row").getField(f.name).alias(f.name) for f in fields], *[c for c in parsed.columns if c != "__row"])
