"""Streams: each file once, repeats, and streams next to loads by batch."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

from varve.operators.versioning import FLAGS
from varve.plans.bronze import ingest_bronze
from varve.sources.store import Store
from varve.spec import TableSpec, Zones
from varve.streaming.landing import append_once, ingest_stream, run_available, stream_landing

CLOCK = datetime(2024, 2, 1, tzinfo=timezone.utc)
T = TableSpec("t", "id", schema="id long, v string")


def land(zones, name, rows):
    path = Path(zones.landing, "t", name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


def flags(spark, zones):
    rows = Store(spark, zones).read("t").collect()
    return sorted((r["id"], r["v"], *[r[f] for f in FLAGS]) for r in rows)


BATCHES = {
    "a.jsonl": [{"id": 1, "v": "x"}, {"id": 2, "v": "y"}],
    "b.jsonl": [{"id": 1, "v": "z"}],
    "c.jsonl": [{"id": 1, "v": "x"}, {"id": 3, "v": "n"}],
}


def test_stream_and_batch_loads_make_one_table(spark, tmp_path):
    stream, batch = Zones(str(tmp_path / "stream"), "s"), Zones(str(tmp_path / "batch"), "s")

    def clock(epoch):
        return CLOCK + timedelta(days=1 + epoch)

    for zones in (stream, batch):
        land(zones, "a.jsonl", BATCHES["a.jsonl"])
        land(zones, "b.jsonl", BATCHES["b.jsonl"])
    ingest_stream(spark, stream, T, clock, store=Store(spark, stream, buckets=2))
    ingest_bronze(spark, batch, T, CLOCK, store=Store(spark, batch, buckets=2))
    assert flags(spark, stream) == flags(spark, batch)
    for zones in (stream, batch):
        land(zones, "c.jsonl", BATCHES["c.jsonl"])
    ingest_stream(spark, stream, T, clock)
    ingest_bronze(spark, batch, T, CLOCK + timedelta(days=1))
    assert flags(spark, stream) == flags(spark, batch)

    # A stream whose checkpoint is lost hands out all files again: none is loaded twice.
    version = Store(spark, stream).commit_of("t").version
    fresh = Zones(stream.root, "s")
    (Path(stream.control) / "stream").rename(Path(stream.control) / "lost")
    ingest_stream(spark, fresh, T, lambda epoch: CLOCK + timedelta(days=9))
    assert Store(spark, stream).commit_of("t").version == version
    # Nor does a load by batch take in what the stream has.
    outcome = ingest_bronze(spark, stream, T, CLOCK + timedelta(days=10))
    assert outcome.status == "no new files"


def test_repeated_micro_batch_replaces_its_rows(spark, tmp_path):
    write = append_once(str(tmp_path / "out"))
    write(spark.range(5), 0)
    write(spark.range(5), 0)
    write(spark.range(2), 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_consumed_files_are_archived(spark, tmp_path):
    zones = Zones(str(tmp_path), "s")
    archive, out = str(tmp_path / "archive"), str(tmp_path / "out")
    for name, rows in BATCHES.items():
        land(zones, name, rows)
        stream = stream_landing(spark, f"{zones.landing}/t", T.schema, archive=archive)
        run_available(stream, str(tmp_path / "checkpoint"), append_once(out))
    assert spark.read.parquet(out).count() == 5


def test_csv_stream_keeps_broken_lines_out_like_a_load(spark, tmp_path):
    spec = TableSpec("t", "id", schema="id BIGINT, v STRING")
    found = []
    for name in ("stream", "batch"):
        zones = Zones(str(tmp_path / name), "s")
        path = Path(zones.landing, "t", "a.csv")
        path.parent.mkdir(parents=True)
        path.write_text("id,v\n1,x\n2\n3,y,z\nfour,w\n5,u\n")
        if name == "stream":
            ingest_stream(spark, zones, spec, lambda epoch: CLOCK, ext="csv")
        else:
            outcome = ingest_bronze(spark, zones, spec, CLOCK)
            assert (outcome.rows, outcome.corrupt) == (2, 3)
        rows = Store(spark, zones).read("t")
        assert "_corrupt_record" not in rows.columns
        found.append(sorted(rows.select("id", "v", "_latest").collect()))
    assert found[0] == found[1] == [(1, "x", True), (5, "u", True)]


def test_stream_needs_a_schema(spark, tmp_path):
    with pytest.raises(ValueError, match="schema"):
        ingest_stream(spark, Zones(str(tmp_path), "s"), TableSpec("t", "id"), lambda epoch: CLOCK)
