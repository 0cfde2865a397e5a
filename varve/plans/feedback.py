"""Detail rows for the keys a bronze table asks for, landed for the next load."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from varve.functions.times import batch_id
from varve.operators.filters import CHUNK_SIZE, worklist
from varve.operators.versioning import INSERT_TS
from varve.session import discard, fresh_dir, materialize_counted, staged, tidy
from varve.sources.fetch import fetch_by_key
from varve.sources.files import land_jsonl
from varve.sources.store import CODEC, Store
from varve.spec import Zones


def feedback_enrich(
    spark: SparkSession,
    zones: Zones,
    leads: str,
    asset: str,
    fetch: Callable[[dict], dict | list[dict] | None],
    schema: T.StructType | str,
    clock: datetime,
    choice: str = "both",
    columns: Sequence[str] = ("campaign_id", "external_system_id"),
    status_col: str = "lead_status",
    key: str = "external_system_id",
    partitions: int | None = None,
    codec: str = "none",
) -> int:
    """Fetch details of a bronze table's work list and land them; gives the rows landed.

    The work list stays distributed, in parts of a chunk's size or less. The fetched rows are written once before they are
    landed, so that no later step repeats a request, and deleted afterwards. ``codec`` is as in
    :func:`varve.sources.files.land_jsonl`.
    """
    rows = Store(spark, zones).read(leads)
    folders = [fresh_dir(spark, name) for name in ("worklist", "details")]
    with tidy(spark):
        wanted, counts = materialize_counted(
            worklist(rows, status_col, choice, INSERT_TS, clock, key, columns), "worklist", path=folders[0]
        )
        chunks = max(-(-counts["rows"] // CHUNK_SIZE), spark.sparkContext.defaultParallelism)
        fetched = fetch_by_key(wanted, fetch, schema, partitions or chunks)
        details, _ = staged(fetched, "details", codec=CODEC, path=folders[1])
        landed = land_jsonl(details, zones, asset, batch_id(asset, clock), codec=codec)
    discard(spark, *folders)
    return landed
