"""Flags: hand-checked cases, laws on random tables, upserts, drift."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from varve.catalog.versions import deleted_in_parts
from varve.functions.hashing import row_hash
from varve.operators.versioning import (
    FLAGS,
    TypeDriftError,
    add_deleted_flag,
    add_version_flags,
    latest,
    union_history,
    upsert_versions,
)
from varve.session import work_dir

SCHEMA = "k string, _row_hash string, ts int, n int"


def table(spark, rows):
    return spark.createDataFrame([(k, h, t, i) for i, (k, h, t) in enumerate(rows)], SCHEMA)


def brute_force(rows):
    """Flags by the definition, over the whole table."""

    def times(match):
        return [t for row in rows for t in [row[2]] if match(row) and t is not None]

    flags = []
    for k, h, t in rows:
        of_key, of_hash = times(lambda r: r[0] == k), times(lambda r: r[1] == h)
        initial = t is not None and t == min(of_key)
        newest = t is not None and t == max(of_key)
        update = t is not None and not initial and t == min(of_hash)
        flags.append((initial, newest, update))
    return flags


def flags_of(df):
    return [tuple(r[f] for f in FLAGS) for r in sorted(df.collect(), key=lambda r: r["n"])]


def random_rows(seed, size=60, times=range(6)):
    """Few keys and hashes; a hash may belong to two keys, as with skipped nulls."""
    pick = random.Random(seed)
    return [
        (pick.choice(["a", "b", "c", None]), pick.choice("uvwxyz"), pick.choice([*times, None]))
        for _ in range(size)
    ]


def test_hand_checked(spark):
    rows = [
        ("1", "a", 1),
        ("1", "a", 2),
        ("1", "b", 2),
        (None, "z", 1),
        (None, "z", 3),
        (None, "y", 3),
        ("2", "c", None),
    ]
    t, f = True, False
    assert flags_of(add_version_flags(table(spark, rows), "k", "ts")) == [
        (t, f, f),
        (f, t, f),
        (f, t, t),
        (t, f, f),
        (f, t, f),
        (f, t, t),
        (f, f, f),
    ]


def test_return_to_old_content_is_no_update(spark):
    rows = [("1", "a", 1), ("1", "b", 2), ("1", "a", 3)]
    assert [u for _, _, u in flags_of(add_version_flags(table(spark, rows), "k", "ts"))] == [
        False,
        True,
        False,
    ]


@pytest.mark.parametrize("seed", range(4))
def test_flags_equal_brute_force(spark, seed):
    rows = random_rows(seed)
    df = table(spark, rows)
    found = flags_of(add_version_flags(df, "k", "ts"))
    assert found == brute_force(rows)
    assert not any(initial and update for initial, _, update in found)
    newest = latest(df, "k", "ts").select("n").collect()
    assert {r["n"] for r in newest} == {n for n, (_, last, _) in enumerate(found) if last}


def test_hash_covers_key(spark):
    rows = [(k, f"{k}{h}", t) for k, h, t in random_rows(7)]
    flagged = add_version_flags(table(spark, rows), "k", "ts", hash_covers_key=True)
    assert flags_of(flagged) == brute_force(rows)


def test_old_flags_are_replaced(spark):
    rows = random_rows(3)
    df = table(spark, rows).withColumns({f: F.lit(True) for f in FLAGS})
    assert flags_of(add_version_flags(df, "k", "ts")) == brute_force(rows)


def test_key_of_two_columns(spark):
    rows = [("1", "a", 1), ("1", "b", 2), ("1", "b", 3)]
    df = table(spark, rows).withColumn("part", F.col("n") % 2)
    assert flags_of(add_version_flags(df, ["k", "part"], "ts")) == [
        (True, False, False),
        (True, True, False),
        (False, True, False),
    ]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("counted", [True, False])
def test_upserts_equal_full_recompute(spark, seed, counted):
    batches = [random_rows(10 * seed + n, 25, times=[2 * n, 2 * n + 1]) for n in range(3)]
    # A stamped row always has a time.
    batches = [[(k, h, t if t is not None else 2 * n) for k, h, t in b] for n, b in enumerate(batches)]
    rows = [row for batch in batches for row in batch]
    df = table(spark, rows)
    ends = [25, 50, 75]
    state = add_version_flags(df.where(F.col("n") < ends[0]), "k", "ts")
    for start, end in zip(ends, ends[1:]):
        new = df.where((F.col("n") >= start) & (F.col("n") < end))
        state = upsert_versions(state, new, "k", "ts", new_rows=end - start if counted else None)
    assert flags_of(state) == brute_force(rows)


def test_upserts_without_a_time_overtake_nothing(spark):
    """New rows whose time is null, of known, null and new keys, beside ones that have a time."""
    schema = "k string, _row_hash string, ts int, n int"
    old = [("a", "x", 1, 0), ("b", "x", 1, 1), (None, "y", 1, 2), ("c", "z", None, 3), ("e", "x", 1, 4)]
    new = [("a", "v", None, 5), (None, "v", None, 6), ("c", "v", None, 7), ("d", "v", None, 8), ("b", "v", 2, 9), ("b", "v", None, 10)]
    state = add_version_flags(spark.createDataFrame(old, schema), "k", "ts")
    for counted in (None, len(new)):
        found = upsert_versions(state, spark.createDataFrame(new, schema), "k", "ts", new_rows=counted)
        got = {r["n"]: (r["_initial"], r["_latest"], r["_update"]) for r in found.collect()}
        no = (False, False, False)
        assert got == {0: (True, True, False), 1: (True, False, False), 2: (True, True, False), 3: no, 4: (True, True, False),
                       5: no, 6: no, 7: no, 8: no, 9: (False, True, True), 10: no}


def test_deleted_rows(spark):
    rows = [("d1", "a", 1), ("d1", "b", 1), ("d1", "a", 2), ("d2", "c", 1)]
    flagged = add_version_flags(table(spark, rows), "k", "ts")
    deleted = add_deleted_flag(flagged, "k", "ts").orderBy("n").collect()
    assert [r["_deleted"] for r in deleted] == [False, True, False, False]


def test_union_fills_and_widens(spark):
    old = spark.createDataFrame([(1, (1,))], "a int, s struct<x:int>")
    new = spark.createDataFrame([(2.5, (2, "t"), "new")], "a double, s struct<x:int,y:string>, b string")
    both = union_history(old, new).orderBy("a").collect()
    assert [(r["a"], r["s"]["y"], r["b"]) for r in both] == [(1.0, None, None), (2.5, "t", "new")]


@pytest.mark.parametrize("kind, value", [("string", "x"), ("struct<x:int>", (1,))])
def test_union_drift(spark, kind, value):
    old = spark.createDataFrame([(1,)], "a long")
    new = spark.createDataFrame([(value,)], f"a {kind}")
    with pytest.raises(TypeDriftError, match="a"):
        union_history(old, new)
    both = union_history(old, new, drift="string")
    assert both.schema["a"].dataType.simpleString() == "string"
    assert {r["a"] for r in both.collect()} == {"1", "x" if kind == "string" else '{"x":1}'}


def test_all_null_column_keeps_strict_hash(spark):
    before = spark.createDataFrame([("a", 1)], "x string, y int")
    after = before.withColumn("z", F.lit(None).cast("string"))
    strict = [d.select(row_hash(d, "strict")).first()[0] for d in (before, after)]
    assert strict[0] == strict[1]


@pytest.mark.parametrize("keys", [0, 100_000])
def test_flags_by_parts_are_those_of_the_whole(spark, monkeypatch, keys):
    """Contents that several keys share, null keys and dates, and newest snapshots in other parts."""
    monkeypatch.setattr("varve.operators.versioning.BROADCAST_ROWS", keys)
    pick = random.Random(11)
    rows = [
        (pick.choice([None, 1, 2, 3]), pick.choice([None, "1", "a", "b"]), pick.choice([None, 1, 2, 3, 4]), pick.choice([None, 7, 8, 9]), n)
        for n in range(120)
    ]
    df = spark.createDataFrame(rows, "k long, v string, ts long, day long, n long")
    args = (["k", "v"], "k", "day", "ts", ["n", "_deleted"])
    one, some = (sorted(map(tuple, deleted_in_parts(df, parts, *args).collect())) for parts in (1, 3))
    assert one == some and len(some) == 120
    assert {r[1] for r in some} == {True, False}


def test_parts_leave_no_hashes_behind(spark):
    before = set(os.listdir(work_dir(spark)))
    df = spark.range(60).selectExpr("id % 9 AS k", "id % 3 AS v", "id AS ts", "id % 4 AS day")
    assert deleted_in_parts(df, 3, ["k", "v"], "k", "day", "ts", ["ts", "_deleted"]).count() == 60
    left = {name.split("-")[0] for name in set(os.listdir(work_dir(spark))) - before}
    assert left == {"newest", "deleted"}
