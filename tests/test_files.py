"""Landing files: scans, headers, corrupt lines, manifest, routing, landing."""

from __future__ import annotations

import os
from datetime import date, datetime, timezone

import pytest

from varve.functions.times import batch_id, clock_micros, iso_utc, lookback
from varve.operators.quality import formats, split_corrupt, verify_checksums
from varve.session import materialize
from varve.sources.files import (
    land_jsonl,
    lookback_start,
    manifest,
    new_files,
    read_csv,
    read_jsonl,
    route_files,
    rows_to_df,
)
from varve.spec import TableSpec, Zones

CLOCK = datetime(2024, 2, 1, 12, tzinfo=timezone.utc)


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_lines_arrays_and_corrupt_lines(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", '{"a":1,"b":"x"}\n[{"a":2},{"a":3,"b":"z"}]\nnull\n{bad\n[]\n{"a":4}\n')
    for schema in (None, "a long, b string"):
        good, bad = split_corrupt(materialize(read_jsonl(spark, path, schema)))
        assert sorted((r["a"], r["b"]) for r in good.collect()) == [(1, "x"), (2, None), (3, "z"), (4, None)]
        assert {r["_corrupt_record"] for r in bad.collect()} == {"null", "{bad"}
        assert all(r["_raw_file_source"].endswith("a.jsonl") for r in bad.collect())


def test_no_corrupt_column_no_bad_lines(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", '{"a":1}\n')
    good, bad = split_corrupt(read_jsonl(spark, path))
    assert (good.count(), bad.count()) == (1, 0)


def test_csv_files_unite_by_column_name(spark, tmp_path):
    paths = [
        put(tmp_path, "1.csv", "a,b\n1,2\n"),
        put(tmp_path, "2.csv", "b,a\n2,1\n"),
        put(tmp_path, "3.csv", "a,c\n1,3\n"),
        put(tmp_path, "4.csv", ""),
    ]
    rows = read_csv(spark, paths).drop("_raw_file_source", "_corrupt_record").collect()
    found = {tuple(sorted(r.asDict().items())) for r in rows}
    assert found == {
        (("a", "1"), ("b", "2"), ("c", None)),
        (("a", "1"), ("b", None), ("c", "3")),
    }
    assert len(rows) == 3


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    path = put(tmp_path, "q.csv", 'a,b\n1,"say ""hi"", then\nleave"\n')
    assert read_csv(spark, path, quote_escape='"', multiline=True).first()["b"] == 'say "hi", then\nleave'
    assert read_csv(spark, path, quote_escape='"').count() == 2  # a split row, as without multiline
    path = put(tmp_path, "p.csv", 'a,b\n1,"say \\"hi\\""\n')
    assert read_csv(spark, path).first()["b"] == 'say "hi"'


def test_broken_csv_lines_keep_their_text(spark, tmp_path):
    path = put(tmp_path, "a.csv", "a,b\n1,x\n2\n3,y,z\nfour,w\n\n5,\n")
    good, bad = split_corrupt(materialize(read_csv(spark, path, "a BIGINT")))
    assert sorted((r["a"], r["b"]) for r in good.collect()) == [(1, "x"), (5, None)]
    assert {r["_corrupt_record"] for r in bad.collect()} == {"2", "3,y,z", "four,w"}
    assert all(r["_raw_file_source"].endswith("a.csv") for r in bad.collect())


def test_manifest_lists_only_waiting_batches(spark, tmp_path):
    zones = Zones(str(tmp_path), "events")  # the source's name is a table's name too
    for name in ("events/a.jsonl", "events/processed/old.jsonl", "events/note.txt", "other/b.csv", "c.jsonl"):
        put(tmp_path / "landing" / "events", name, "{}\n")
    put(tmp_path / "landing" / "events", "other/batch=w.csv/part-0.csv", "a\n")
    put(tmp_path / "landing" / "events", "other/batch=w.csv/_SUCCESS", "")
    rows = manifest(spark, zones.landing).collect()
    assert {(r["table"], r["batch"], r["ext"], r["name"]) for r in rows} == {
        ("events", "a.jsonl", "jsonl", "a.jsonl"),
        ("other", "b.csv", "csv", "b.csv"),
        ("other", "w.csv", "csv", "part-0.csv"),
    }
    assert {os.path.basename(r["folder"]) for r in rows} == {"a.jsonl", "b.csv", "batch=w.csv"}
    assert [r["table"] for r in manifest(spark, zones.landing, ["events"]).collect()] == ["events"]


def test_mixed_formats_show(spark):
    files = rows_to_df(
        spark,
        [{"table": "a", "ext": "csv"}, {"table": "a", "ext": "jsonl"}, {"table": "b", "ext": "csv"}],
        "table string, ext string",
    )
    assert {r["table"]: r["ok"] for r in formats(files).collect()} == {"a": False, "b": True}


def test_routes(spark):
    names = [
        "Transactions_2024-01-02.csv",
        "Declines20240102_10-20-30.csv",
        "Transactions_20240102_102030.csv",
        "Refunds_20240102.csv",
        "Transactions_2024.csv",
        None,
    ]
    files = spark.createDataFrame([(n,) for n in names], "name string")
    routed, unmatched = route_files(files)
    day = date(2024, 1, 2)
    assert {(r["table"], r["date"], r["time"]) for r in routed.collect()} == {
        ("Transactions", day, None),
        ("Declines", day, "10-20-30"),
        ("Transactions", day, "102030"),
    }
    assert unmatched.count() == 3
    seen = files.where("name = 'Transactions_2024-01-02.csv'")
    assert new_files(routed, seen).count() == 2


def test_land_counts_and_skips_empty(spark, tmp_path):
    zones = Zones(str(tmp_path), "s")
    df = spark.range(5)
    assert land_jsonl(df, zones, "t", batch_id("t", CLOCK)) == 5
    assert land_jsonl(df.where("id < 0"), zones, "t", "none") == 0
    assert manifest(spark, zones.landing).select("batch").distinct().count() == 1
    with pytest.raises(ValueError, match="empty"):
        land_jsonl(df.where("id < 0"), zones, "t", "none2", drop_empty=False)


def test_null_fields_on_request(spark, tmp_path):
    zones = Zones(str(tmp_path), "s")
    df = spark.createDataFrame([(1, None)], "a int, b string")
    land_jsonl(df, zones, "t", "x", keep_nulls=True)
    assert read_jsonl(spark, f"{zones.landing}/t/x.jsonl").columns[:2] == ["a", "b"]


def test_checksums_of_files(spark, tmp_path):
    for name, text in (("a.bin", "alpha"), ("b.bin", "beta"), ("c.bin", "gamma")):
        put(tmp_path, name, text)
    files = (
        spark.read.format("binaryFile")
        .load(str(tmp_path))
        .selectExpr("element_at(split(path, '/'), -1) AS name", "content")
    )
    stated = files.selectExpr(
        "name", "concat('sha256:', sha2(if(name = 'b.bin', encode('other', 'UTF-8'), content), 256)) AS checksum"
    ).where("name <> 'c.bin'")
    stated = stated.union(spark.createDataFrame([("lost.bin", "sha256:00")]))
    found = {r["name"]: r["ok"] for r in verify_checksums(files, stated).collect()}
    assert found == {"a.bin": True, "b.bin": False, "c.bin": False, "lost.bin": False}


def test_names_and_clocks(spark):
    names = {batch_id("t", CLOCK) for _ in range(50)}
    assert len(names) == 50 and all(n.startswith("t_20240201T120000_") for n in names)
    with pytest.raises(ValueError):
        batch_id("a/b", CLOCK)
    with pytest.raises(ValueError, match="zone"):
        clock_micros(datetime(2024, 1, 1))
    row = spark.range(1).select(lookback(CLOCK, 3).alias("d")).first()
    assert row["d"] == date(2024, 1, 29)
    assert lookback_start(CLOCK, 1) == datetime(2024, 1, 31)
    text = spark.sql("SELECT timestamp'2024-01-02 03:04:05' AS t").select(iso_utc("t")).first()[0]
    assert text == "2024-01-02T03:04:05Z"


@pytest.mark.parametrize(
    "make",
    [
        lambda: Zones("/r", "a/b"),
        lambda: Zones("/r", "a").path("attic"),
        lambda: TableSpec("a/b", "id"),
        lambda: TableSpec("a", ()),
        lambda: TableSpec("a", "id", hash_mode="fast"),
    ],
)
def test_arguments_are_checked(make):
    with pytest.raises(ValueError):
        make()


def test_zone_paths():
    zones = Zones("/r/", "s")
    assert (zones.landing, zones.gold) == ("/r/landing/s", "/r/gold/s")
    assert (zones.control, zones.bronze, zones.silver) == ("/r/control/s", "/r/bronze/s", "/r/silver/s")
