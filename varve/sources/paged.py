"""Paged sources read by executors.

The transport is the caller's: a function that fetches one page. It runs in executors,
again when a task is retried, so it must be safe to repeat.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from varve.functions.columns import column
from varve.sources.files import as_struct
from varve.spec import one_of

# Fixed value: rows per page of an offset-paged source.
PAGE_SIZE = 200


class Stripe(InputPartition):
    """Every ``step``-th page from ``first``, without a known end."""

    def __init__(self, first: int, step: int) -> None:
        self.first, self.step = first, step


class Pages(InputPartition):
    """The pages from ``first`` up to and without ``end``."""

    def __init__(self, first: int, end: int) -> None:
        self.first, self.end = first, end


class PagedSource(DataSource):
    """``format("paged")``: pages of a remote listing as rows.

    Options: ``fetch`` (a pickled function, see :func:`read_paged`), ``mode``,
    ``page_size``, ``partitions``.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> T.StructType:
        raise ValueError("a paged source needs a schema")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        fetch = cloudpickle.loads(base64.b64decode(self.options["fetch"]))
        partitions = int(self.options.get("partitions", 8))
        if self.options.get("mode", "offset") == "counted":
            return CountedReader(schema, fetch, partitions)
        return OffsetReader(schema, fetch, partitions, int(self.options.get("page_size", PAGE_SIZE)))


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, fetch: Callable, stripes: int) -> None:
        self.names, self.fetch, self.stripes = schema.names, fetch, stripes

    def rows(self, found: Sequence[dict]) -> Iterator[tuple]:
        for row in found:
            yield tuple(row.get(name) for name in self.names)


class OffsetReader(_Reader):
    """``fetch(offset, limit)`` gives a list of rows, none past the end.

    The total is unknown, so each stripe goes on until a page is empty.
    """

    def __init__(self, schema, fetch, stripes: int, page_size: int) -> None:
        super().__init__(schema, fetch, stripes)
        self.page_size = page_size

    def partitions(self) -> list[Stripe]:
        return [Stripe(n, self.stripes) for n in range(self.stripes)]

    def read(self, partition: Stripe) -> Iterator[tuple]:
        page = partition.first
        while True:
            offset, end = page * self.page_size, (page + 1) * self.page_size
            # A page may come short without being the last: go on by the rows received.
            while offset < end:
                found = self.fetch(offset, end - offset)
                if not found:
                    return
                offset += len(found)
                yield from self.rows(found)
            page += partition.step


class CountedReader(_Reader):
    """``fetch(page)`` gives ``{"rows", "total_pages", "total_record"}``, pages from 1."""

    def partitions(self) -> list[Pages]:
        pages = int(self.fetch(1)["total_pages"])
        edges = [1 + pages * n // self.stripes for n in range(self.stripes + 1)]
        found = [Pages(first, end) for first, end in zip(edges, edges[1:]) if first < end]
        return found or [Pages(1, 1)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        for page in range(partition.first, partition.end):
            yield from self.rows(self.fetch(page)["rows"])


def read_paged(
    spark: SparkSession,
    fetch: Callable,
    schema: T.StructType | str,
    mode: str = "offset",
    page_size: int = PAGE_SIZE,
    partitions: int | None = None,
) -> DataFrame:
    """Rows of a paged listing, its pages fetched side by side by executors.

    ``offset``: ``fetch(offset, limit)``, advancing by the rows received up to an empty
    page (S16). ``counted``: ``fetch(page)`` with declared totals, which
    :func:`varve.operators.quality.totals` checks (S17).
    """
    one_of(mode, ("offset", "counted"), "mode")
    spark.dataSource.register(PagedSource)
    return (
        spark.read.format("paged")
        .schema(as_struct(schema))
        .option("fetch", base64.b64encode(cloudpickle.dumps(fetch)).decode())
        .option("mode", mode)
        .option("page_size", page_size)
        .option("partitions", partitions or spark.sparkContext.defaultParallelism)
        .load()
    )


def to_batch(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    """Rows as an Arrow batch; a field a row lacks is null, one the schema lacks drops."""
    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


class NoRecords(Exception):
    """A source says that it has no rows in the window; not a failure."""


def read_counted_by_key(
    keys: DataFrame,
    fetch: Callable[[dict, int], dict],
    schema: T.StructType | str,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All pages of many counted listings, one per key row.

    ``fetch(key, page)`` gives ``{"rows", "total_pages", "total_record"}`` or raises
    :class:`NoRecords`. First every key's page 1 tells its page count; then the single
    pages are spread over the cluster, so that a key with very many pages is no hot task.
    Gives the rows with their key columns in front, and the totals declared per key.
    """
    spark = keys.sparkSession
    partitions = partitions or spark.sparkContext.defaultParallelism
    key_names, row_fields = list(keys.columns), as_struct(schema).fields
    declared_schema = T.StructType(
        [
            *keys.schema.fields,
            T.StructField("total_pages", T.LongType()),
            T.StructField("total_record", T.LongType()),
        ]
    )

    out_schema = T.StructType(
        [*keys.schema.fields, *[f for f in row_fields if f.name not in key_names]]
    )

    def sizes(key: dict) -> dict:
        try:
            first = fetch(key, 1)
        except NoRecords:
            return {**key, "total_pages": 0, "total_record": 0}
        return {**key, "total_pages": first["total_pages"], "total_record": first["total_record"]}

    def count(batches):
        for batch in batches:
            yield to_batch([sizes(key) for key in batch.to_pylist()], declared_schema)

    def pages(batches):
        for batch in batches:
            for key in batch.to_pylist():
                page = key.pop("_page")
                yield to_batch([{**key, **row} for row in fetch(key, page)["rows"]], out_schema)

    declared = keys.repartition(partitions, *[column(k) for k in key_names]).mapInArrow(
        count, declared_schema
    )
    listed = declared.where("total_pages > 0").select(
        *[column(k) for k in key_names],
        F.explode(F.sequence(F.lit(1).cast("long"), "total_pages")).alias("_page"),
    )
    spread = listed.repartition(partitions, *[column(k) for k in key_names], F.col("_page"))
    return spread.mapInArrow(pages, out_schema), declared
