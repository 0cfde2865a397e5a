"""Paged sources and keyed fetches."""

from __future__ import annotations

import pytest

from remote import ParquetPages

from varve.operators.quality import listing_complete, require, totals
from varve.sources.fetch import Throttled, fetch_by_key, with_retry
from varve.sources.paged import NoRecords, read_counted_by_key, read_paged


def test_short_pages_are_followed_to_the_end(spark):
    def fetch(offset, limit):
        return [{"id": n} for n in range(offset, min(offset + min(limit, 3), 50))]

    df = read_paged(spark, fetch, "id long", page_size=7, partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert sorted(r["id"] for r in df.collect()) == list(range(50))


def test_empty_listing(spark):
    assert read_paged(spark, lambda offset, limit: [], "id long").count() == 0


def test_counted_pages(spark):
    def fetch(page):
        rows = [{"id": n} for n in range((page - 1) * 4, min(page * 4, 10))]
        return {"rows": rows, "total_pages": 3, "total_record": 10}

    df = read_paged(spark, fetch, "id long, missing string", mode="counted")
    assert sorted(r["id"] for r in df.collect()) == list(range(10))
    with pytest.raises(ValueError, match="mode"):
        read_paged(spark, fetch, "id long", mode="random")


def test_counted_listing_without_pages(spark):
    empty = {"rows": [], "total_pages": 0, "total_record": 0}
    assert read_paged(spark, lambda page: empty, "id long", mode="counted").count() == 0


def test_pages_of_a_folder_of_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).repartition(3).write.option("parquet.block.size", 1024).parquet(path)
    pages = ParquetPages(path)
    found = [r["id"] for n in range(8) for r in pages.counted(n + 1, 130)["rows"]]
    assert sorted(found) == list(range(1000)) and pages.rows(1000, 5) == []


def test_counted_by_key_spreads_pages_and_checks_totals(spark):
    sizes = {"a": 5, "b": 0, "c": 1, "d": None}

    def fetch(key, page):
        size = sizes[key["campaign"]]
        if size is None:
            raise NoRecords
        rows = [{"n": n, "lead": f"{key['campaign']}{n}"} for n in range((page - 1) * 2, min(page * 2, size))]
        declared = 9 if key["campaign"] == "c" else size
        return {"rows": rows, "total_pages": -(-size // 2), "total_record": declared}

    keys = spark.createDataFrame([(k,) for k in sizes], "campaign string")
    rows, declared = read_counted_by_key(keys, fetch, "lead string, n long", partitions=3)
    assert sorted(r["lead"] for r in rows.collect()) == ["a0", "a1", "a2", "a3", "a4", "c0"]
    assert rows.columns == ["campaign", "lead", "n"]
    checked = totals(rows, declared, "campaign", "total_record")
    assert {r["campaign"]: r["ok"] for r in checked.collect()} == {"a": True, "b": True, "c": False, "d": True}
    with pytest.raises(ValueError, match="'c'"):
        require(checked, "totals")


def test_listings_are_complete_or_told(spark):
    bodies = [
        ("whole", 1, 2, 3, 2, None), ("whole", 2, 2, 3, 1, None),
        ("no last page", 1, 2, 3, 2, None),
        ("page twice", 1, 1, 2, 2, None), ("page twice", 1, 1, 2, 2, None),
        ("changed total", 1, 2, 3, 2, None), ("changed total", 2, 2, 4, 1, None),
        ("beyond the end", 1, 1, 2, 1, None), ("beyond the end", 2, 1, 2, 1, None),
        ("nothing", 1, None, None, 0, "No records found "),
        ("nothing, yet rows", 1, 1, 1, 1, "no records found"),
        ("no totals", 1, None, None, 1, None),
        (None, 1, 1, 1, 1, None),
    ]
    columns = "listing string, page long, total_pages long, total_record long, received long, message string"
    checked = listing_complete(spark.createDataFrame(bodies, columns), "listing").collect()
    assert {r["listing"] for r in checked if r["ok"]} == {"whole", "beyond the end", "nothing", None}
    assert len(checked) == 9
    empty = listing_complete(spark.createDataFrame([], columns), "listing")
    assert empty.count() == 0


def test_payload_shapes_and_name_clash(spark):
    def fetch(key):
        return {
            1: {"v": "one", "id": 100},  # the payload wins
            2: [{"v": "x"}, {"v": "y", "unknown": 1}],
            3: None,
            4: [],
        }[key["id"]]

    keys = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    rows = fetch_by_key(keys, fetch, "id long, v string").collect()
    assert sorted((r["id"], r["v"]) for r in rows) == [(2, "x"), (2, "y"), (100, "one")]


def test_null_keys_stay_null(spark):
    keys = spark.createDataFrame([(None, 1), (2, None)], "a long, b long")
    rows = fetch_by_key(keys, lambda key: {"seen": str(key)}, "a long, b long, seen string").collect()
    assert {r["seen"] for r in rows} == {"{'a': None, 'b': 1}", "{'a': 2, 'b': None}"}


def test_only_throttled_requests_are_tried_again():
    calls = []

    def fetch(key):
        calls.append(key)
        if len(calls) < 3:
            raise Throttled(0)
        return {"ok": True}

    assert with_retry(fetch, {"id": 1}) == {"ok": True} and len(calls) == 3

    def always(key):
        raise Throttled(0)

    with pytest.raises(Throttled):
        with_retry(always, {"id": 1})

    def broken(key):
        calls.append(key)
        raise KeyError("no")

    calls.clear()
    with pytest.raises(KeyError):
        with_retry(broken, {"id": 1})
    assert len(calls) == 1
