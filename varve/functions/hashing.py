"""Row and record hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.functions.columns import column
from varve.spec import one_of

# to_json cuts times to milliseconds and writes them in the session zone by default.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timeZone": "UTC",
}


def business_fields(schema: T.StructType) -> list[T.StructField]:
    """Fields that are data, not metadata (no leading underscore), in name order."""
    return sorted((f for f in schema if not f.name.startswith("_")), key=lambda f: f.name)


NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def _plain_text(value: Column, kind: T.DataType) -> Column:
    """A value as text that does not follow the session's zone: times are told in UTC."""
    if isinstance(kind, T.TimestampType):
        seconds = (F.unix_micros(value).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
        none = F.lit(0)
        value = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(none, none, none, seconds)
    return value.cast("string")


def _as_text(field: T.StructField) -> Column:
    value, kind = column(field.name), field.dataType
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, NESTED):
        return F.transform(value, lambda item: _plain_text(item, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.to_json(canonical(value, kind), JSON_TIMES)
    if isinstance(kind, NESTED):
        return F.to_json(value, JSON_TIMES)
    return _plain_text(value, kind)


def canonical(value: Column, kind: T.DataType) -> Column:
    """The value with the fields of its structs and the keys of its maps in order."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind, key=lambda f: f.name)
        parts = [canonical(value.getField(f.name), f.dataType).alias(f.name) for f in fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, NESTED):
        return F.transform(value, lambda item: canonical(item, kind.elementType))
    if isinstance(kind, T.MapType):
        keys = F.array_sort(F.map_keys(value))
        values = F.transform(keys, lambda key: canonical(value[key], kind.valueType))
        return F.map_from_arrays(keys, values)
    return value


def row_hash(df: DataFrame, mode: str = "compat") -> Column:
    """SHA-256 hex over the business columns of ``df`` in name order.

    ``compat`` joins the values with ``|`` and skips nulls, so a null may hide which
    column a value came from. ``strict`` hashes the names too and has no such clash.
    Either way times count in UTC and to the microsecond, also inside structs, arrays and
    maps, so the hash is the same in every session.
    """
    one_of(mode, ("compat", "strict"), "hash mode")
    fields = business_fields(df.schema)
    if mode == "strict":
        return record_hash(df, [f.name for f in fields])
    return F.sha2(F.concat_ws("|", *[_as_text(f) for f in fields]), 256)


def record_hash(
    df: DataFrame,
    cols: list[str] | None = None,
    normalise: dict[str, Column] | None = None,
) -> Column:
    """SHA-256 hex of the record's JSON with its columns in name order.

    ``normalise`` replaces a column's value before hashing, e.g. with a default for a
    missing sub-record or a cast to one number type. Null fields leave no trace in the
    JSON, so adding a column that is still empty keeps old hashes.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    normalise = normalise or {}
    names = sorted(cols if cols is not None else [f.name for f in business_fields(df.schema)])
    missing = [n for n in names if n not in kinds]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    values = [
        normalise[n] if n in normalise else canonical(column(n), kinds[n]) for n in names
    ]
    record = F.struct(*[v.alias(n) for n, v in zip(names, values)])
    return F.sha2(F.to_json(record, JSON_TIMES), 256)
