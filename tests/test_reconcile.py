"""Digest trees and extract gaps against plain versions."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from varve.operators.filters import extract_gaps
from varve.operators.reconcile import differing_leaves, leaf_digests, row_differences

SCHEMA = "a long, b string, c double, d array<int>"


def some_rows(rng, count):
    return [(rng.randint(0, 40), rng.choice(["x", "y", None]), rng.choice([0.5, float("nan"), None]), rng.choice([[1], [], None])) for _ in range(count)]


def seen(row):
    return tuple("nan" if isinstance(v, float) and v != v else tuple(v) if isinstance(v, list) else v for v in row)


@pytest.mark.parametrize("seed", range(3))
def test_differences_equal_multiset_subtraction(spark, seed):
    rng = random.Random(seed)
    left = some_rows(rng, 300)
    right = [r for r in left if rng.random() < 0.97] + some_rows(rng, 5)
    rng.shuffle(right)
    found = row_differences(spark.createDataFrame(left, SCHEMA).repartition(5), spark.createDataFrame(right, SCHEMA), (0, 3, 7))
    a, b = Counter(map(seen, left)), Counter(map(seen, right))
    expected = {("left", *r): n for r, n in (a - b).items()} | {("right", *r): n for r, n in (b - a).items()}
    assert {("left" if r["side"] == "left" else "right", *seen(tuple(r)[1:-1])): r["copies"] for r in found.collect()} == expected


def test_equal_tables_end_at_the_root(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    one, two = leaf_digests(df), leaf_digests(df.orderBy(F.desc("id")).repartition(3))
    assert differing_leaves(one, two).count() == 0
    assert row_differences(df, df.select("v", "id")).count() == 0
    assert row_differences(df.limit(0), df.limit(0)).count() == 0


def test_only_differing_leaves_are_compared(spark):
    df = spark.range(20_000)
    other = df.where("id <> 77")
    leaves = differing_leaves(leaf_digests(df), leaf_digests(other)).collect()
    assert len(leaves) == 1
    assert leaf_digests(df).count() > 4000
    assert [tuple(r) for r in row_differences(df, other).collect()] == [("left", 77, 1)]
    with pytest.raises(ValueError, match="different columns"):
        row_differences(df, df.withColumn("x", F.lit(1)))


def test_rows_that_swap_leaves_do_not_cancel(spark):
    """The same number of rows, with the same total of their values, but not the same rows."""
    left, right = spark.createDataFrame([(1, 4), (2, 3)], "a int, b int"), spark.createDataFrame([(1, 3), (2, 4)], "a int, b int")
    assert row_differences(left, right).count() == 4


def plain_gaps(rows, low, high):
    out = []
    for key in {k for k, _, _ in rows}:
        at = low
        for start, end in sorted((max(a, low), min(b, high)) for k, a, b in rows if k == key and a is not None and b is not None):
            if end > start:
                if start > at:
                    out.append((key, at, start))
                at = max(at, end)
        if high > at:
            out.append((key, at, high))
    return Counter(out)


@pytest.mark.parametrize("pieces", [1, 7, 256])
def test_gaps_equal_a_plain_sweep(spark, pieces):
    rng, day = random.Random(pieces), datetime(2024, 1, 1)
    rows = []
    for _ in range(400):
        start = day + timedelta(minutes=rng.randint(-600, 9000))
        rows.append((rng.choice(["a", "b", None]), start, start + timedelta(minutes=rng.choice([-5, 0, 3, 10, 600]))))
    rows += [("none", day, None), ("none", None, day), ("far", day - timedelta(days=9), day + timedelta(days=90)), ("edge", day, day + timedelta(days=1))]
    rows += [("hot", day + timedelta(minutes=5), day + timedelta(minutes=6))] * 50
    df = spark.createDataFrame(rows, "k string, s timestamp_ntz, e timestamp_ntz")
    high = day + timedelta(days=5)
    found = extract_gaps(df, "k", "s", "e", day, high, pieces)
    assert Counter(map(tuple, found.collect())) == plain_gaps(rows, day, high)
    assert extract_gaps(df.limit(0), "k", "s", "e", day, high, pieces).count() == 0
