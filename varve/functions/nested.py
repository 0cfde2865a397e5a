"""JSON text and nested results to columns and rows."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.functions.columns import column
from varve.functions.json_paths import json_paths, schema_of_paths


def inferred_schema(df: DataFrame, col: str) -> T.StructType:
    """Schema of the JSON objects in a text column, by the kinds of all their paths."""
    paths = json_paths(df, col).select("steps", "kind").distinct().collect()
    found = schema_of_paths([(r["steps"], r["kind"]) for r in paths])
    if not isinstance(found, T.StructType):
        raise ValueError(f"column {col!r} holds no JSON objects (found {found.simpleString()})")
    return found


def json_to_struct(df: DataFrame, col: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Replace a JSON text column by the struct it holds.

    Without ``schema`` the data is read to infer it. Malformed text gives a null struct's fields:
    :func:`varve.functions.json_paths.split_malformed` tells such rows apart, to be kept and counted.
    """
    schema = schema if schema is not None else inferred_schema(df, col)
    return df.withColumn(col, F.from_json(column(col), schema))


def has_tag(col: Column, path: str, value: str) -> Column:
    """True where the JSON text holds ``value`` at ``path``; absent tags are false."""
    return F.coalesce(F.get_json_object(col, path) == value, F.lit(False))


def unpack_envelope(
    bodies: DataFrame,
    body: str,
    rows_field: str,
    row_schema: str,
    ok: str = "status AND message = 'Success'",
    envelope_schema: str = "status BOOLEAN, message STRING",
    keep: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split response bodies into their rows and the rejected bodies.

    A body passes when ``ok`` is true for it and it reports no ``errors``; its rows sit
    in ``rows_field``, as an array of objects or as one object. ``keep`` names key columns
    and envelope fields, such as ``warnings``, to put in front of every row. ``rejected``
    keeps the whole body with its message, errors and warnings, and the ``reason``: the
    envelope is not ok, it has errors, or its rows field is there but is neither.
    """
    keep = keep or []
    schema = (
        f"{envelope_schema}, warnings ARRAY<STRING>, errors ARRAY<STRING>, "
        f"`{rows_field}` STRING"
    )
    row = T._parse_datatype_string(row_schema)
    text = F.ltrim(column(rows_field))
    parsed = bodies.withColumn("_envelope", F.from_json(column(body), schema))
    envelope_names = [f.name for f in parsed.schema["_envelope"].dataType]
    flat = parsed.select(
        *bodies.columns, *[F.col("_envelope")[n].alias(n) for n in envelope_names]
    ).withColumn(
        "_rows",
        F.when(text.startswith("["), F.from_json(text, T.ArrayType(row))).when(
            text.startswith("{"), F.array(F.from_json(text, row))
        ),
    )
    flat = flat.withColumn(
        "reason",
        F.when(~F.coalesce(F.expr(ok), F.lit(False)), "not ok")
        .when(F.coalesce(F.size("errors"), F.lit(0)) > 0, "errors")
        .when(column(rows_field).isNotNull() & F.col("_rows").isNull(), "rows are neither an array nor an object"),
    )
    rows = flat.where("reason IS NULL").select(*[column(k) for k in keep], F.inline("_rows"))
    rejected = flat.where("reason IS NOT NULL").select(
        *bodies.columns, *[n for n in envelope_names if n != rows_field and n not in bodies.columns], "reason"
    )
    return rows, rejected


def reject_any(rejected: DataFrame) -> None:
    """Fail when any body was rejected, naming one."""
    first = rejected.first()
    if first is not None:
        logging.error("rejected body: %s", first.asDict())
        raise ValueError(f"a response was not successful: {first.asDict()}")
