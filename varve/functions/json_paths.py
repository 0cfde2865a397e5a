"""What JSON text holds: every path with its types and counts, and the schema that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.functions.columns import column
from varve.session import materialize

# Levels below which nested values are left as text.
DEPTH = 64
# What a variant's type is called in JSON; whole and other numbers are told apart.
_KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null", "BIGINT": "integer"}

_VALUE, _STEPS, _KIND = "__value", "__steps", "__kind"


def split_malformed(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose text is JSON or null, and those whose text is not, all columns kept."""
    broken = column(col).isNotNull() & F.try_parse_json(column(col)).isNull()
    return df.where(~broken), df.where(broken)


def _kind(value: Column) -> Column:
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair]), name), F.lit("number"))


def _inside(level: DataFrame) -> DataFrame:
    """The values inside objects and arrays, one level down."""
    view = level.sparkSession.tvf.variant_explode(F.col(_VALUE).outer())
    found = level.lateralJoin(view)
    step = F.when(F.col(_KIND) == "array", F.lit("[]")).otherwise(F.concat(F.lit("."), F.col("key")))
    return found.select(F.col("value").alias(_VALUE), F.array_append(_STEPS, step).alias(_STEPS))


def json_paths(df: DataFrame, col: str, depth: int = DEPTH) -> DataFrame:
    """(steps, path, kind, count) of all values in a JSON text column; text that is no JSON is one of its own.

    ``steps`` names the way to a value: ``.key`` for a field and ``[]`` for any element of an array;
    ``path`` is these as text, after ``$``. ``kind`` is object, array, string, boolean, null, integer,
    number (any other), or ``malformed``, which has no steps. Null text counts nowhere. Values more than
    ``depth`` levels down are not looked into. Counts combine before they shuffle, so a path that every
    row has is no hot group.
    """
    text = df.select(column(col).alias("__text")).where(F.col("__text").isNotNull())
    parsed = text.select(F.try_parse_json("__text").alias(_VALUE), F.array().cast("array<string>").alias(_STEPS))
    counts = parsed.where(F.col(_VALUE).isNull()).groupBy(_STEPS).agg(F.count("*").alias("count"))
    found = [counts.select(_STEPS, F.lit("malformed").alias(_KIND), "count")]
    level = parsed.where(F.col(_VALUE).isNotNull())
    for _ in range(depth):
        typed = materialize(level.withColumn(_KIND, _kind(F.col(_VALUE))), "json-level")
        found.append(typed.groupBy(_STEPS, _KIND).agg(F.count("*").alias("count")))
        nested = typed.where(F.col(_KIND).isin("object", "array"))
        if nested.isEmpty():
            break
        level = _inside(nested)
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    path = F.concat(F.lit("$"), F.array_join(_STEPS, ""))
    return whole.select(F.col(_STEPS).alias("steps"), path.alias("path"), F.col(_KIND).alias("kind"), "count")


def schema_of_paths(rows: list[tuple[list[str], str]]) -> T.DataType:
    """The type that holds all values of the (steps, kind) pairs found; a path of several kinds is text.

    Integers among other numbers become doubles. A path that was always null, or has a kind that
    excludes another, is text, with all below it.
    """
    kinds: dict[tuple[str, ...], set[str]] = {}
    for steps, kind in rows:
        if kind != "malformed":
            kinds.setdefault(tuple(steps), set()).add(kind)

    def below(steps: tuple[str, ...]) -> list[tuple[str, ...]]:
        return sorted(s for s in kinds if len(s) == len(steps) + 1 and s[: len(steps)] == steps)

    def kind_of(steps: tuple[str, ...]) -> T.DataType:
        own = kinds.get(steps, set()) - {"null"}
        if own == {"object"}:
            fields = [T.StructField(s[-1][1:], kind_of(s)) for s in below(steps)]
            return T.StructType(fields) if fields else T.StringType()
        if own == {"array"}:
            return T.ArrayType(kind_of((*steps, "[]")))
        plain = {frozenset({"boolean"}): T.BooleanType(), frozenset({"integer"}): T.LongType(), frozenset({"number"}): T.DoubleType()}
        return {**plain, frozenset({"integer", "number"}): T.DoubleType()}.get(frozenset(own), T.StringType())

    return kind_of(())
