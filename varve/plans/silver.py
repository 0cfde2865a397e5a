"""Bronze to silver: the current rows of every table."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from varve.operators.filters import current
from varve.plans.bronze import Outcome, run_tables
from varve.sources.store import Store
from varve.spec import TableSpec, Zones


def silver_view(bronze: DataFrame, spec: TableSpec | None = None, drop_meta: bool = False) -> DataFrame:
    """Current rows under the table's own predicate, optionally without metadata columns."""
    rows = current(bronze, spec.where if spec else None)
    if drop_meta:
        rows = rows.drop(*[c for c in rows.columns if c.startswith("_")])
    return rows


def publish_silver(
    spark: SparkSession,
    zones: Zones,
    specs: Sequence[TableSpec] = (),
    drop_meta: bool = False,
) -> list[Outcome]:
    """Bring the silver table of every bronze table up to date (K3).

    A silver row depends on its bronze row alone, so only buckets that bronze has written
    since the last time are published again; all of them when the rule has changed. One
    table's failure does not spread.
    """
    bronze = Store(spark, zones)
    known = {s.name: s for s in specs}

    def publish(table: str) -> Outcome:
        spec, source = known.get(table), bronze.commit_of(table)
        silver = Store(spark, zones, "silver", source.buckets)
        old = silver.commit_of(table)
        text = f"{spec.where if spec else None}, {drop_meta}, {source.schema.json()}"
        rule = sha256(text.encode()).hexdigest()
        current = source.open_buckets()
        derived = {"origin": current, "rule": rule}
        if old is None or old.rule != rule or old.buckets is None:
            rows = silver_view(bronze.read_or_none(table, is_open=True), spec, drop_meta)
            key = source.key if set(source.key) <= set(rows.columns) else None
            return Outcome(table, "loaded", silver.replace(rows, table, key, **derived).rows)
        changed = [b for b in {*current, *old.origin} if current.get(b) != old.origin.get(b)]
        if not changed:
            return Outcome(table, "no new files")
        rows = silver_view(bronze.read_or_none(table, changed, is_open=True), spec, drop_meta)
        return Outcome(table, "loaded", silver.replace_buckets(rows, table, changed, **derived).rows)

    return run_tables({t: lambda t=t: publish(t) for t in bronze.tables()})
