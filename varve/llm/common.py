"""What several operators share: names that cannot clash, Arrow batches, staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

# White space is the six ASCII characters only, in every operator.
WORD = r"[^\x20\x09-\x0D]+"

# Texts that one step of a Python worker holds at once, in characters. A longer text is a step of its own.
CHUNK_CHARS = 1 << 20


def spare(df: DataFrame, *names: str) -> list[str]:
    """Column names for the inner use of an operator that none of ``df``'s own columns has."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def text_of(column: str = "text") -> Column:
    """The text, where a null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def remainder(column: str, modulus: int) -> Column:
    """crc32 of a column as text, modulo ``modulus``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))) % modulus


def pieces(batches, column: str, limit: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a piece stay near ``limit`` bytes together."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).to_pylist()
        start, held = 0, 0
        for n, size in enumerate(sizes):
            if n > start and held + size > limit:
                yield batch.slice(start, n - start)
                start, held = n, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def chunks(batches, column: str, limit: int = CHUNK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """:func:`pieces` with their texts."""
    for piece in pieces(batches, column, limit):
        yield piece, piece.column(piece.schema.get_field_index(column)).to_pylist()


def map_texts(df: DataFrame, keep: list[str], text: Column, body: Callable, schema: str) -> DataFrame:
    """Run ``body(texts) -> arrays`` over all texts; its arrays follow the columns ``keep``.

    ``body`` gets a list of texts and returns one list or array for each column of
    ``schema``. It works on pieces of bounded size, so memory does not grow with the input.
    """
    inner = spare(df, "__text")[0]
    kept = df.select(*[f"`{k}`" for k in keep])
    target = StructType(kept.schema.fields + _parse_datatype_string(schema).fields)
    names = [f.name for f in target]

    def run(batches):
        for piece, texts in chunks(batches, inner):
            made = [x if isinstance(x, pa.Array) else pa.array(x) for x in body(texts)]
            yield pa.RecordBatch.from_arrays([*piece.columns[: len(keep)], *made], names=names)

    return df.select(*[f"`{k}`" for k in keep], text.alias(inner)).mapInArrow(run, target)


def parts_for(rows: int, each: int) -> int:
    return max(1, ceil(rows / each))
