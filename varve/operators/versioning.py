"""Version flags over a table's row versions.

All flags come from three minima and maxima per group. They are built from a narrow
(key, hash, time) table by hash aggregates, which combine before they shuffle, and are
joined back to the rows once, on key and hash. A key that holds much of the table, or
the group of null keys, is so never gathered in one task, and AQE may split its join
partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.functions.columns import column, same
from varve.session import BROADCAST_ROWS, broadcast_if_small
from varve.spec import key_columns, one_of

FLAGS = ("_initial", "_latest", "_update")
INSERT_TS = "_bronze_insert_ts"
ROW_HASH = "_row_hash"

_FIRST, _LAST, _SEEN, _HASH, _TIME = "__first", "__last", "__seen", "__hash", "__time"


def _key_aliases(key: Sequence[str]) -> list[str]:
    return [f"__key{i}" for i in range(len(key))]


def _narrow(df: DataFrame, key: Sequence[str], ts: str, row_hash: str) -> DataFrame:
    keys = [column(k).alias(a) for k, a in zip(key, _key_aliases(key))]
    return df.select(*keys, column(row_hash).alias(_HASH), column(ts).alias(_TIME))


def _renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({n: f"{n}_r" for n in names})


def _matches(names: Sequence[str]) -> Column:
    """Condition for a join with a :func:`_renamed` table, nulls equal."""
    return same((F.col(n), F.col(f"{n}_r")) for n in names)


def _with(
    left: DataFrame, right: DataFrame, names: Sequence[str], rows: int = BROADCAST_ROWS + 1
) -> DataFrame:
    """Left join on ``names``; ``right`` has at most ``rows`` rows."""
    other = broadcast_if_small(_renamed(right, names), rows)
    return left.join(other, _matches(names), "left").drop(*[f"{n}_r" for n in names])


def part_of(parts: int, row_hash: str = ROW_HASH) -> Column:
    """Which of ``parts`` parts a row is in; rows of one hash are in one part."""
    return F.pmod(F.xxhash64(column(row_hash)), F.lit(parts)).cast("int")


def key_times(df: DataFrame, key: str | Sequence[str], ts: str = INSERT_TS) -> DataFrame:
    """First and last time of every key."""
    key = key_columns(key)
    names = _key_aliases(key)
    times = df.select(*[column(k).alias(a) for k, a in zip(key, names)], column(ts).alias(_TIME))
    return times.groupBy(*names).agg(F.min(_TIME).alias(_FIRST), F.max(_TIME).alias(_LAST))


def with_key_times(
    df: DataFrame, by_key: DataFrame, key: str | Sequence[str], keys: int = BROADCAST_ROWS + 1
) -> DataFrame:
    """Rows with the :func:`key_times` of their key, of which there are ``keys`` by count."""
    names = _key_aliases(key_columns(key))
    held = same((column(k), F.col(n)) for k, n in zip(key_columns(key), names))
    return df.join(broadcast_if_small(by_key, keys), held, "left").drop(*names)


def flag_stats(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str = INSERT_TS,
    row_hash: str = ROW_HASH,
    hash_covers_key: bool = False,
) -> DataFrame:
    """Per (key, hash): first and last time of the key, first time of the hash.

    ``hash_covers_key`` says that equal hashes imply equal keys, which spares a step.
    """
    key = key_columns(key)
    names = _key_aliases(key)
    narrow = _narrow(df, key, ts, row_hash)
    by_key = key_times(df, key, ts)
    groups = narrow.groupBy(*names, _HASH).agg(F.min(_TIME).alias(_SEEN))
    stats = _with(groups, by_key, names)
    if hash_covers_key:
        return stats
    # Both uses of the groups read the same columns, so that Spark shuffles them once.
    by_hash = groups.groupBy(_HASH).agg(F.min(_SEEN).alias("__anywhere"))
    return _with(stats, by_hash, [_HASH]).withColumn(_SEEN, F.least(_SEEN, "__anywhere"))


def apply_flags(
    df: DataFrame,
    stats: DataFrame,
    key: str | Sequence[str],
    ts: str = INSERT_TS,
    row_hash: str = ROW_HASH,
) -> DataFrame:
    """Set the flags of rows from the stats of their key and hash."""
    key = key_columns(key)
    rows = df.drop(*FLAGS)
    names = [*_key_aliases(key), _HASH]
    condition = same((column(c), F.col(n)) for c, n in zip([*key, row_hash], names))
    return _flagged(rows.join(stats, condition, "left"), rows.columns, ts)


def _flagged(joined: DataFrame, columns: Sequence[str], ts: str) -> DataFrame:
    at, first, last, seen = column(ts), F.col(_FIRST), F.col(_LAST), F.col(_SEEN)
    flags = (at == first, at == last, (at != first) & (at == seen))
    return joined.select(
        *[column(c) for c in columns],
        *[F.coalesce(f, F.lit(False)).alias(n) for n, f in zip(FLAGS, flags)],
    )


def add_version_flags(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str = INSERT_TS,
    row_hash: str = ROW_HASH,
    hash_covers_key: bool = False,
    timed: bool = False,
) -> DataFrame:
    """Add ``_initial``, ``_latest`` and ``_update``, replacing old ones.

    ``_initial``: the row is of the first batch of its key. ``_latest``: it is of the
    newest batch of its key; several rows may be. ``_update``: it is not initial and its
    content was first seen in its batch. A null time gives no flag; null keys are one
    group. The key may be a business date, whose newest snapshot then is the latest.

    A table may be flagged a part at a time, cut by :func:`part_of`, which bounds what is
    shuffled at once. Its rows are then ``timed``: they have got the times of their key in
    the whole table :func:`with_key_times`, and the hash alone is left to join by.
    """
    if timed:
        rows = df.drop(*FLAGS)
        seen = _narrow(df, [], ts, row_hash).groupBy(_HASH).agg(F.min(_TIME).alias(_SEEN))
        joined = rows.join(seen, same([(column(row_hash), F.col(_HASH))]), "left")
        return _flagged(joined, [c for c in rows.columns if c not in (_FIRST, _LAST)], ts)
    return apply_flags(df, flag_stats(df, key, ts, row_hash, hash_covers_key), key, ts, row_hash)


def latest(df: DataFrame, key: str | Sequence[str], ts: str = INSERT_TS) -> DataFrame:
    """Rows of the newest batch of each key, without stored flags."""
    key = key_columns(key)
    names = _key_aliases(key)
    newest = df.groupBy(*[column(k).alias(n) for k, n in zip(key, names)]).agg(
        F.max(column(ts)).alias(_LAST)
    )
    condition = same((column(k), F.col(n)) for k, n in zip(key, names))
    return df.join(newest, condition & (column(ts) == F.col(_LAST)), "left_semi")


def newest_of(df: DataFrame, date_col: str, ts: str = INSERT_TS) -> DataFrame:
    """Time of the newest snapshot of every date."""
    return df.groupBy(column(date_col).alias("__date")).agg(F.max(column(ts)).alias("__newest"))


def add_deleted_flag(
    df: DataFrame,
    date_col: str,
    ts: str = INSERT_TS,
    row_hash: str = ROW_HASH,
    newest: DataFrame | None = None,
) -> DataFrame:
    """Add ``_deleted``: the content is missing from the newest snapshot of its date.

    Needs a right ``_latest`` and complete snapshots: every batch that holds a date holds
    all its rows. ``newest`` has the :func:`newest_of` all rows, where ``df`` is only a part
    of them by :func:`part_of`.
    """
    # The newest snapshot of a date is found over all its rows: those that hold it may have
    # been overtaken under another date.
    newest = newest_of(df, date_col, ts) if newest is None else newest
    held = column(date_col).eqNullSafe(F.col("__date")) & (column(ts) == F.col("__newest"))
    current = df.where("_latest").join(newest, held, "left_semi")
    alive = current.select(column(row_hash).alias("__alive")).distinct()
    joined = df.join(alive, column(row_hash) == F.col("__alive"), "left")
    return joined.withColumn("_deleted", F.col("__alive").isNull()).drop("__alive")


class TypeDriftError(ValueError):
    """A column changed its type in a way that has no safe common type."""


_WIDENING = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType]


def _common_type(old: T.DataType, new: T.DataType) -> T.DataType | None:
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if type(old) in _WIDENING and type(new) in _WIDENING:
        return max(old, new, key=lambda kind: _WIDENING.index(type(kind)))
    if {type(old), type(new)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        fields = {f.name: f.dataType for f in old}
        for field in new:
            known = fields.get(field.name)
            kind = field.dataType if known is None else _common_type(known, field.dataType)
            if kind is None:
                return None
            fields[field.name] = kind
        return T.StructType([T.StructField(n, k) for n, k in fields.items()])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        element = _common_type(old.elementType, new.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        value = _common_type(old.valueType, new.valueType)
        return None if value is None else T.MapType(old.keyType, value)
    return None


def _as_string(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(column(name))
    return column(name).cast("string")


def drifted(old: T.StructType, new: T.StructType) -> dict[str, T.DataType | None]:
    """Columns in both schemas whose type differs, with their common type if any."""
    known = {f.name: f.dataType for f in old}
    return {
        f.name: _common_type(known[f.name], f.dataType)
        for f in new
        if f.name in known and known[f.name].simpleString() != f.dataType.simpleString()
    }


def union_history(old: DataFrame, new: DataFrame, drift: str = "fail") -> DataFrame:
    """History and new rows by column name; a column one side lacks is null there.

    Numbers widen and structs gain fields. Any other change of a type fails here, before
    a job runs, or turns the column to text on both sides with ``drift="string"``.
    """
    one_of(drift, ("fail", "string"), "drift")
    clash = [name for name, kind in drifted(old.schema, new.schema).items() if kind is None]
    if clash and drift == "fail":
        kinds = {
            n: f"{old.schema[n].dataType.simpleString()} -> {new.schema[n].dataType.simpleString()}"
            for n in clash
        }
        raise TypeDriftError(f"columns changed type: {kinds}")
    for name in clash:
        old = old.withColumn(name, _as_string(name, old.schema[name].dataType))
        new = new.withColumn(name, _as_string(name, new.schema[name].dataType))
    return old.unionByName(new, allowMissingColumns=True)


def upsert_versions(
    history: DataFrame,
    new: DataFrame,
    key: str | Sequence[str],
    ts: str = INSERT_TS,
    row_hash: str = ROW_HASH,
    drift: str = "fail",
    new_rows: int | None = None,
    hash_history: DataFrame | None = None,
) -> DataFrame:
    """Flagged history plus new rows; flags change for the keys in ``new`` only.

    Equals a full :func:`add_version_flags` as long as all new times are later than those
    of the history. Rows of the history can then only lose ``_latest``, so ``history`` may
    be cut down to rows that have it, of keys that may be in ``new``; ``hash_history``,
    where to look for known content, must still be whole. The flags are found from the
    key, hash and time columns. ``new_rows``, if the caller has counted them, bounds the
    tables joined to the history, which are broadcast when it is small.
    """
    key = key_columns(key)
    names = _key_aliases(key)
    rows = new_rows if new_rows is not None else BROADCAST_ROWS + 1
    fresh = _narrow(new, key, ts, row_hash)

    def joined_by(source: DataFrame, by: list[str]) -> DataFrame:
        wanted = broadcast_if_small(_renamed(fresh.select(*by).distinct(), by), rows)
        found = source.join(wanted, _matches(by), "left_semi")
        return found.unionByName(fresh).groupBy(*by)

    by_key = joined_by(_narrow(history, key, ts, row_hash), names).agg(
        F.min(_TIME).alias(_FIRST), F.max(_TIME).alias(_LAST)
    )
    seen = _narrow(hash_history if hash_history is not None else history, key, ts, row_hash)
    by_hash = joined_by(seen, [_HASH]).agg(F.min(_TIME).alias(_SEEN))

    groups = fresh.select(*names, _HASH).distinct()
    stats = _with(_with(groups, by_key, names, rows), by_hash, [_HASH], rows)
    added = apply_flags(new, broadcast_if_small(stats, rows), key, ts, row_hash)

    condition = same((column(k), F.col(n)) for k, n in zip(key, names))
    marked = history.join(broadcast_if_small(by_key, rows), condition, "left")
    # A key that the new rows lack has neither time. Both uses of the times by key read the same
    # columns, so that Spark scans and shuffles for them once.
    overtaken = F.col("_latest") & (F.col(_FIRST).isNull() | (column(ts) == F.col(_LAST)))
    kept = marked.select(
        *[overtaken.alias(c) if c == "_latest" else column(c) for c in history.columns]
    )
    return union_history(kept, added, drift)
