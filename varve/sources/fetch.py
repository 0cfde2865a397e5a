"""Keyed enrichment: detail rows fetched per key by executors."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from varve.functions.columns import column
from varve.operators.filters import CHUNK_SIZE
from varve.sources.files import as_struct
from varve.sources.paged import to_batch

# Fixed value: how often a throttled request is tried.
ATTEMPTS = 3


class Throttled(Exception):
    """The service asks to wait (status 429) for ``retry_after`` seconds."""

    def __init__(self, retry_after: float) -> None:
        super().__init__(f"throttled, retry after {retry_after} s")
        self.retry_after = retry_after


def with_retry(fetch: Callable, key: dict, attempts: int = ATTEMPTS):
    """Call ``fetch(key)``, waiting as told when throttled; the last refusal is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return fetch(key)
        except Throttled as refusal:
            if attempt == attempts:
                raise
            time.sleep(refusal.retry_after)


def fetch_by_key(
    keys: DataFrame,
    fetch: Callable[[dict], dict | list[dict] | None],
    schema: T.StructType | str,
    partitions: int | None = None,
    concurrency: int = 8,
    attempts: int = ATTEMPTS,
) -> DataFrame:
    """Detail rows of every key: ``{**key, **item}``, the payload winning a name clash.

    ``fetch(key)`` gives a dict, a list of them or None, and may raise
    :class:`Throttled`; only that request is tried again. Keys are spread by their hash
    and fetched a batch of rows at a time, ``concurrency`` at once per task. A retried
    task fetches its keys again, so ``fetch`` must be safe to repeat.
    """
    spark = keys.sparkSession
    partitions = partitions or spark.sparkContext.defaultParallelism
    out = as_struct(schema)

    def details(batches):
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                wanted = batch.to_pylist()
                for start in range(0, len(wanted), CHUNK_SIZE):
                    part = wanted[start : start + CHUNK_SIZE]
                    results = pool.map(lambda key: with_retry(fetch, key, attempts), part)
                    rows = []
                    for key, result in zip(part, results):
                        items = [result] if isinstance(result, dict) else result or []
                        rows.extend({**key, **item} for item in items)
                    yield to_batch(rows, out)

    spread = keys.repartition(partitions, *[column(k) for k in keys.columns])
    return spread.mapInArrow(details, out)
