"""Dated snapshot files: from a file drop to the newest snapshot of every date (P5)."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from varve.operators.quality import require
from varve.plans.bronze import Outcome, ingest_bronze, run_tables
from varve.plans.silver import publish_silver
from varve.sources.digests import verify_files
from varve.sources.files import TRANSACTION_FILES, manifest, new_files, route_files
from varve.sources.store import Store
from varve.spec import TableSpec, Zones


def select_snapshots(
    offered: DataFrame, seen: DataFrame, pattern: str = TRANSACTION_FILES
) -> tuple[DataFrame, DataFrame]:
    """Offered files to take over, with their table and date, and names that do not fit."""
    routed, unmatched = route_files(offered, pattern)
    return new_files(routed, seen), unmatched


def snapshot_transactions(
    spark: SparkSession,
    zones: Zones,
    specs: Mapping[str, TableSpec],
    clock: datetime,
    code_version: str | None = None,
    checksums: DataFrame | None = None,
    buckets: int = 64,
) -> list[Outcome]:
    """Load landed snapshot files and publish the newest snapshot per business date.

    Each table's key is its business date, so the newest file that holds a date replaces
    all earlier rows of that date. ``checksums`` (``name``, ``checksum``, and ``bytes`` if
    known), if given, must hold for the named files that wait before anything is loaded;
    other files are not read for it.
    """
    if checksums is not None:
        require(verify_files(manifest(spark, zones.landing, list(specs)), checksums), "checksum mismatch")
    store = Store(spark, zones, buckets=buckets)
    loads = {
        name: lambda spec=spec: ingest_bronze(spark, zones, spec, clock, code_version, store)
        for name, spec in specs.items()
    }
    outcomes = run_tables(loads)
    publish_silver(spark, zones, list(specs.values()))
    return outcomes
