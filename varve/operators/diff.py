"""Table diff and duplicate names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.functions.columns import column
from varve.session import written_report


def table_diff(
    new: DataFrame,
    old: DataFrame,
    key: str,
    row_hash: str,
    id_col: str | None = None,
) -> DataFrame:
    """One row per key of either side with its ``change``.

    ``add``: only in ``new``. ``remove``: only in ``old``. ``unchanged`` or ``update``:
    in both, by the null-safe comparison of the hashes. With ``id_col`` the existing id
    is carried. Keys must be unique on each side; see :func:`duplicates`.
    """
    left = new.select(column(key).alias("__new"), column(row_hash).alias("new_hash"), F.lit(True).alias("__in_new"))
    ids = [column(id_col).alias(id_col)] if id_col else []
    right = old.select(
        column(key).alias("__old"), column(row_hash).alias("old_hash"), *ids, F.lit(True).alias("__in_old")
    )
    joined = left.join(right, F.col("__new").eqNullSafe(F.col("__old")), "full_outer")
    change = (
        F.when(F.col("__in_old").isNull(), "add")
        .when(F.col("__in_new").isNull(), "remove")
        .when(F.col("new_hash").eqNullSafe(F.col("old_hash")), "unchanged")
        .otherwise("update")
    )
    return joined.select(
        F.coalesce("__new", "__old").alias(key), change.alias("change"), "new_hash", "old_hash", *([id_col] if id_col else [])
    )


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Names that occur more than once when case is ignored, with their count (A2)."""
    return (
        df.groupBy(F.lower(column(key)).alias("name"))
        .agg(F.count("*").alias("n"))
        .where("n > 1")
    )


def require_unique(df: DataFrame, key: str) -> None:
    """Fail when a name occurs twice; all such names are written, the most frequent are named."""
    path, rows = written_report(duplicates(df, key), "duplicates")
    if rows:
        most = df.sparkSession.read.parquet(path).orderBy(F.desc("n"), "name").take(3)
        named = ", ".join(f"{r['name']} ({r['n']})" for r in most)
        raise ValueError(f"names are not unique: {rows}, all in {path}, such as {named}")
