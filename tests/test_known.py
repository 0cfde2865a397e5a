"""Known-content bitmaps: no part that holds a hash is left out, and others are skipped."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from varve.operators import known
from varve.operators.known import BITS, bitmaps_for, content_bitmaps, may_hold
from varve.plans.bronze import ingest_bronze
from varve.sources.files import land_jsonl
from varve.sources.store import Store
from varve.spec import TableSpec, Zones

CLOCK = datetime(2024, 1, 1, tzinfo=timezone.utc)
SPEC = TableSpec("t", "id", schema="id BIGINT, v STRING")


def hashed(spark, rows):
    return spark.createDataFrame(rows, "part int, text string").select("part", F.sha2("text", 256).alias("_row_hash"))


@pytest.mark.parametrize("bitmaps", [1, 4, 64])
def test_every_part_with_a_hash_is_found(spark, bitmaps):
    rng = random.Random(bitmaps)
    rows = [(n % 20, f"c{rng.randint(0, 3000)}") for n in range(4000)] + [(77, None)]
    stored = hashed(spark, rows)
    index = content_bitmaps(stored, ["part"], bitmaps)
    assert index.count() <= 20 * bitmaps and index.where("length(bits) <> 4096").count() == 0
    for size in (0, 1, 5, 40):
        new = [(0, f"c{rng.randint(0, 6000)}") for _ in range(size)] + [(0, None)]
        texts = {t for _, t in new if t}
        found = {r["part"] for r in may_hold(index, ["part"], hashed(spark, new)).collect()}
        assert found >= {p for p, t in rows if t in texts}
        if bitmaps == 64 and size <= 1:
            assert found == {p for p, t in rows if t in texts}


def test_indexes_of_several_sizes_are_searched_alike(spark):
    one, two = hashed(spark, [(1, "a"), (1, "b")]), hashed(spark, [(2, "b"), (2, "c")])
    index = content_bitmaps(one, ["part"], 1).union(content_bitmaps(two, ["part"], 8))
    find = lambda text: {r["part"] for r in may_hold(index, ["part"], hashed(spark, [(0, text)])).collect()}
    assert [find(t) for t in "abcd"] == [{1}, {1, 2}, {2}, set()]
    assert may_hold(index.limit(0), ["part"], one).collect() == []


def test_bitmaps_grow_with_the_part():
    assert [bitmaps_for(n) for n in (0, 1, 512, 513, 5_000, 10**12)] == [1, 1, 1, 2, 16, known.MOST_BITMAPS]
    assert bitmaps_for(1_000_000) * BITS >= 64 * 1_000_000


def scanned_parts(df):
    """Stored parts that the scans of a plan read."""
    found = set()
    for file in df.inputFiles():
        found.add(file.split("/gen=")[1].rsplit("/", 1)[0])
    return found


def load(spark, zones, rows, day):
    land_jsonl(spark.createDataFrame(rows, "id long, v string"), zones, "t", f"t_{day:02d}")
    ingest_bronze(spark, zones, SPEC, CLOCK + timedelta(days=day), store=Store(spark, zones, buckets=8))


def test_a_load_opens_only_parts_that_may_hold_its_content(spark, tmp_path):
    zones = Zones(str(tmp_path), "s")
    for day in range(3):
        load(spark, zones, [(n, f"v{n}.{day}") for n in range(200)], day)
    store = Store(spark, zones, buckets=8)
    base = store.commit_of("t")
    stored = {f"{g}/{part}" for part, found in base.parts.items() for g in found}
    assert len(stored) > 20
    whole = store.read("t")
    assert scanned_parts(whole) == stored
    new = whole.where("id = 7 AND v = 'v7.0'").union(whole.limit(1).withColumn("_row_hash", F.lit("never seen")))
    few = store.read_content("t", new, base)
    assert len(scanned_parts(few)) == 1
    assert few.where("v = 'v7.0'").count() == 1
    assert store.read_content("t", whole, base).count() == whole.count()


def test_loads_flag_known_content_as_a_full_recompute_does(spark, tmp_path):
    """Content comes back under its own key and under others, old and new, over many loads."""
    from varve.operators.versioning import add_version_flags

    rng, zones = random.Random(3), Zones(str(tmp_path), "s")
    spec = TableSpec("t", "_k", schema="_k BIGINT, v STRING")
    store = Store(spark, zones, buckets=4)
    for day in range(5):
        rows = [(rng.randint(0, 40), f"v{rng.randint(0, 15 + 10 * day)}") for _ in range(25)]
        land_jsonl(spark.createDataFrame(rows, "_k long, v string"), zones, "t", f"t_{day:02d}")
        ingest_bronze(spark, zones, spec, CLOCK + timedelta(days=day), store=store)
    stored = store.read("t")
    columns = ["_k", "v", "_bronze_insert_ts", "_initial", "_latest", "_update"]
    full = add_version_flags(stored, "_k").select(*columns)
    assert sorted(map(tuple, stored.select(*columns).collect())) == sorted(map(tuple, full.collect()))
    assert stored.where("_update").count() > 5


def test_a_table_without_bitmaps_is_read_whole(spark, tmp_path):
    zones = Zones(str(tmp_path), "s")
    load(spark, zones, [(n, f"v{n}") for n in range(20)], 0)
    store = Store(spark, zones, buckets=8)
    known_folder = f"{zones.control}/bronze/t/known"
    from varve.session import discard

    discard(spark, known_folder)
    base = store.commit_of("t")
    assert store.read_content("t", store.read("t").limit(1), base).count() == 20
    load(spark, zones, [(3, "v3"), (4, "other")], 1)
    assert store.read("t").where("_update").count() == 1
