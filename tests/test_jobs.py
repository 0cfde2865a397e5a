"""Loads: idempotence, evolution, failures, silver."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from varve.operators.versioning import TypeDriftError
from varve.plans import bronze
from varve.plans.bronze import LoadFailure, ingest_all, ingest_bronze, quarantined, report, waiting
from varve.plans.feedback import feedback_enrich
from varve.plans.silver import publish_silver
from varve.plans.snapshots import snapshot_transactions
from varve.session import CLEANUP, materialize, ship, tidy, work_dir
from varve.sources.files import land_batches
from varve.sources.store import Store
from varve.spec import TableSpec, Zones

CLOCK = datetime(2024, 2, 1, tzinfo=timezone.utc)


@pytest.fixture
def zones(tmp_path):
    return Zones(str(tmp_path), "s")


def land(zones, table, name, rows):
    """A landing file; rows are dicts, or raw text."""
    path = Path(zones.landing, table, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(rows if isinstance(rows, str) else "".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def load(spark, zones, spec, days=0, **options):
    store = Store(spark, zones, buckets=2)
    return ingest_bronze(spark, zones, spec, CLOCK + timedelta(days=days), store=store, **options)


def state(spark, zones, table, *columns, as_text=False):
    rows = Store(spark, zones).read(table).collect()
    return sorted(tuple(str(r[c]) if as_text else r[c] for c in columns) for r in rows)


T = TableSpec("t", "id")


def test_evolving_loads(spark, zones):
    land(zones, "t", "b.jsonl", [{"id": 1, "v": "x"}, {"id": None, "v": "n"}])
    land(zones, "t", "a.jsonl", [{"id": 1, "v": "w"}, {"id": 2, "v": "y"}])
    assert load(spark, zones, T).rows == 4
    # The name order of the files decides, not their age: "a" comes first.
    assert state(spark, zones, "t", "v", "_initial", "_latest", "_update") == [
        ("n", True, True, False),
        ("w", True, False, False),
        ("x", False, True, True),
        ("y", True, True, False),
    ]
    assert load(spark, zones, T, 1).status == "no new files"
    # A new column, a missing one, and whole numbers where there were none before.
    land(zones, "t", "c.jsonl", [{"id": 1, "extra": 1.5}, {"id": None, "v": "n2"}])
    assert load(spark, zones, T, 2).rows == 2
    land(zones, "t", "d.jsonl", [{"id": 1, "extra": 2}])
    assert load(spark, zones, T, 3).rows == 1
    rows = Store(spark, zones).read("t").collect()
    newest = {(r["id"], r["v"], r["extra"]) for r in rows if r["_latest"]}
    assert newest == {(1, None, 2.0), (2, "y", None), (None, "n2", None)}
    assert len(rows) == 7 and len({r["_bronze_insert_ts"] for r in rows}) == 4


@pytest.mark.parametrize("mode", ["compat", "strict"])
def test_many_loads_equal_one(spark, zones, monkeypatch, mode):
    """Loads that close, append and compact, against all batches at once."""
    monkeypatch.setattr("varve.plans.bronze.GENERATIONS", 2)
    pick, spec = random.Random(5), TableSpec("t", "id", schema="id long, v string, n long", hash_mode=mode)
    once = Zones(zones.root, "once")
    for day in range(5):
        rows = []
        for _ in range(12):
            # Equal content of a null id and of a null value clashes in compat hashes.
            one, other = pick.choice([None, 1, 2, 3]), pick.choice([None, "1", "a", "b"])
            rows.append({"id": one, "v": other})
        for where in (zones, once):
            land(where, "t", f"day{day}.jsonl", rows)
        load(spark, zones, spec, day)
    load(spark, once, spec)
    columns = ("id", "v", "_row_hash", "_initial", "_latest", "_update")
    days = [state(spark, where, "t", *columns, as_text=True) for where in (zones, once)]
    assert days[0] == days[1] and len(days[0]) == 60
    closed = [g for p, g in Store(spark, zones).commit_of("t").parts.items() if "false" in p]
    assert max(map(len, closed)) <= 2


def test_widened_type_rewrites_history(spark, zones):
    land(zones, "t", "a.jsonl", [{"id": 1, "v": 1}, {"id": 2, "v": 2}])
    load(spark, zones, T)
    land(zones, "t", "b.jsonl", [{"id": 1, "v": 1.5}])
    load(spark, zones, T, 1)
    assert state(spark, zones, "t", "id", "v", "_latest") == [(1, 1.0, False), (1, 1.5, True), (2, 2.0, True)]


def test_type_drift_fails_early_or_turns_to_text(spark, zones):
    land(zones, "t", "a.jsonl", [{"id": 1, "v": 1}])
    load(spark, zones, T)
    land(zones, "t", "b.jsonl", [{"id": 1, "v": "one"}])
    with pytest.raises(TypeDriftError):
        load(spark, zones, T, 1)
    assert state(spark, zones, "t", "v") == [(1,)]
    load(spark, zones, TableSpec("t", "id", drift="string"), 1)
    assert state(spark, zones, "t", "v", "_latest") == [("1", False), ("one", True)]


def test_corrupt_lines_are_kept_out_and_counted(spark, zones):
    path = land(zones, "t", "a.jsonl", '{"id":1}\n{oops\nnull\n')
    outcome = load(spark, zones, T)
    assert (outcome.rows, outcome.corrupt) == (1, 2)
    assert {r["_corrupt_record"] for r in quarantined(spark, T, [path]).collect()} == {"{oops", "null"}


def test_crash_before_commit_repeats_cleanly(spark, zones, monkeypatch):
    land(zones, "t", "a.jsonl", [{"id": 1}])
    folder = type(Store(spark, zones)._commits("t"))
    with monkeypatch.context() as patch:
        patch.setattr(folder, "create", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load(spark, zones, T)
    assert load(spark, zones, T).rows == 1
    assert state(spark, zones, "t", "id") == [(1,)]


def test_clock_must_advance(spark, zones):
    land(zones, "t", "a.jsonl", [{"id": 1}])
    load(spark, zones, T)
    land(zones, "t", "b.jsonl", [{"id": 1}])
    with pytest.raises(ValueError, match="clock"):
        load(spark, zones, T)


def test_archive(spark, zones):
    land(zones, "t", "a.jsonl", [{"id": 1}])
    load(spark, zones, T, archive=True)
    land(zones, "t", "b.jsonl", [{"id": 2}])
    assert load(spark, zones, T, 1, archive=True).rows == 1
    assert state(spark, zones, "t", "id") == [(1,), (2,)]


def test_one_failure_does_not_stop_the_others(spark, zones):
    land(zones, "bad", "a.jsonl", [{"id": 1}])
    land(zones, "bad", "b.csv", "id\n1\n")
    land(zones, "good", "a.csv", "id,v\n1,x\n")
    land(zones, "nokey", "a.jsonl", [{"other": 1}])
    land(zones, "unknown", "a.jsonl", [{"id": 1}])
    specs = [TableSpec(n, "id") for n in ("bad", "good", "nokey")]
    with pytest.raises(LoadFailure) as failure:
        ingest_all(spark, zones, specs, CLOCK)
    rows = {r["table"]: r for r in report(spark, failure.value.outcomes).collect()}
    assert {t: r["status"] for t, r in rows.items()} == {
        "bad": "failed",
        "good": "loaded",
        "nokey": "failed",
        "unknown": "failed",
    }
    assert "mixed" in rows["bad"]["error"] and "key" in rows["nokey"]["error"]
    assert "settings" in rows["unknown"]["error"]
    assert state(spark, zones, "good", "id", "v") == [("1", "x")]


def test_silver_follows_changed_buckets_and_rules(spark, zones):
    land(zones, "t", "a.jsonl", [{"id": n, "v": n} for n in range(20)])
    load(spark, zones, T)
    silver = Store(spark, zones, "silver")
    assert publish_silver(spark, zones)[0].rows == 20
    assert publish_silver(spark, zones)[0].status == "no new files"
    land(zones, "t", "b.jsonl", [{"id": 3, "v": 33}])
    load(spark, zones, T, 1)
    assert publish_silver(spark, zones)[0].rows < 20
    assert sorted(r["v"] for r in silver.read("t").collect()) == sorted([*range(3), 33, *range(4, 20)])
    publish_silver(spark, zones, [TableSpec("t", "id", where="try_cast(id AS integer) < 5")], drop_meta=True)
    assert silver.read("t").columns == ["id", "v"] and silver.read("t").count() == 5


def test_checksums_gate_snapshots(spark, zones):
    land(zones, "Declines", "Declines_20240101.csv", "PaymentEffectiveDate,amount\n2024-01-01,5\n")
    specs = {"Declines": TableSpec("Declines", "PaymentEffectiveDate")}
    wrong = spark.createDataFrame([("Declines_20240101.csv", "sha256:00")], "name string, checksum string")
    with pytest.raises(ValueError, match="checksum"):
        snapshot_transactions(spark, zones, specs, CLOCK, checksums=wrong)
    assert Store(spark, zones).read_or_none("Declines") is None
    right = spark.sql(
        """SELECT 'Declines_20240101.csv' AS name,
                  concat('sha256:', sha2('PaymentEffectiveDate,amount\\n2024-01-01,5\\n', 256)) AS checksum"""
    )
    outcomes = snapshot_transactions(spark, zones, specs, CLOCK, checksums=right, buckets=2)
    assert [o.status for o in outcomes] == ["loaded"]
    land(zones, "Declines", "Declines_20240102.csv", "PaymentEffectiveDate,amount\n2024-01-01,6\n2024-01-01,7\n")
    snapshot_transactions(spark, zones, specs, CLOCK + timedelta(days=1))
    silver = Store(spark, zones, "silver").read("Declines")
    assert sorted(r["amount"] for r in silver.collect()) == ["6", "7"]


def test_a_load_that_commits_meanwhile_wins(spark, zones, monkeypatch):
    """The later commit fails; no file is taken in twice, no row is lost, a repeat succeeds."""
    import varve.plans.bronze as bronze

    land(zones, "t", "a.jsonl", [{"id": 1, "v": "a"}])
    load(spark, zones, T)
    for when, name, day in (("materialize_counted", "b", 1), ("upsert_versions", "c", 3)):
        land(zones, "t", f"{name}.jsonl", [{"id": 1, "v": name}, {"id": 2, "v": name}])
        real = getattr(bronze, when)

        def meanwhile(*args, **options):
            monkeypatch.setattr(bronze, when, real)
            land(zones, "t", f"{name}2.jsonl", [{"id": 1, "v": name + "2"}])
            load(spark, zones, T, day)
            return real(*args, **options)

        monkeypatch.setattr(bronze, when, meanwhile)
        with pytest.raises(RuntimeError, match="another writer"):
            load(spark, zones, T, day + 0.5)
        assert load(spark, zones, T, day + 0.75).status == "no new files"
    files = [r["file"] for r in Store(spark, zones).consumed("t").collect()]
    assert len(files) == len(set(files)) == 5
    assert state(spark, zones, "t", "id", "v") == sorted(
        [(1, "a"), (1, "b"), (2, "b"), (1, "b2"), (1, "c"), (2, "c"), (1, "c2")]
    )


def test_a_key_that_widened_stays_one_key(spark, zones):
    for day, ids in enumerate((["1", "2"], ["1.0", "2.5"], ["1", "2"])):
        land(zones, "t", f"{day}.jsonl", "".join(f'{{"id": {i}, "v": "{day}"}}\n' for i in ids))
        load(spark, zones, T, day)
    rows = state(spark, zones, "t", "id", "v", "_initial", "_latest")
    assert rows == [
        (1.0, "0", True, False), (1.0, "1", False, False), (1.0, "2", False, True),
        (2.0, "0", True, False), (2.0, "2", False, True), (2.5, "1", True, True),
    ]


def test_text_history_is_not_written_again(spark, zones):
    spec = TableSpec("t", "id", drift="string")
    for day, v in enumerate(("1", '"x"', "2", "3")):
        land(zones, "t", f"{day}.jsonl", f'{{"id": {day}, "v": {v}}}\n')
        load(spark, zones, spec, day)
    commit = Store(spark, zones).commit_of("t")
    assert commit.rows < 4 and state(spark, zones, "t", "v") == [("1",), ("2",), ("3",), ("x",)]


@pytest.mark.parametrize("keys", [0, 100_000])
@pytest.mark.parametrize("mode", ["compat", "strict"])
def test_a_load_in_parts_equals_one(spark, zones, monkeypatch, mode, keys):
    """Equal content under several keys, null keys, and broken lines, flagged a part at a time."""
    monkeypatch.setattr("varve.operators.versioning.BROADCAST_ROWS", keys)
    pick, spec = random.Random(7), TableSpec("t", "id", schema="id long, v string", hash_mode=mode)
    once = Zones(zones.root, "once")
    for day in range(4):
        rows = [{"id": pick.choice([None, 1, 2, 3]), "v": pick.choice([None, "1", "a", "b"])} for _ in range(15)]
        text = "".join(json.dumps(r) + "\n" for r in rows) + "{broken\n"
        for where in (zones, once):
            land(where, "t", f"day{day}.jsonl", text)
    assert (load(spark, once, spec).rows, len(Store(spark, once).commit_of("t").consumed)) == (60, 1)
    monkeypatch.setattr("varve.plans.bronze.PART_BYTES", 700)
    outcome = load(spark, zones, spec)
    assert (outcome.rows, outcome.corrupt) == (60, 4)
    columns = ("id", "v", "_row_hash", "_initial", "_latest", "_update")
    assert state(spark, zones, "t", *columns, as_text=True) == state(spark, once, "t", *columns, as_text=True)


def test_a_load_looks_up_its_files_once(spark, zones, monkeypatch):
    """Files are listed and compared with those taken in by one query; later loads take new ones only."""
    seen = spark.sparkContext.accumulator(0)

    def noted(folder):
        seen.add(1)
        return folder

    monkeypatch.setattr(bronze, "waiting", lambda *a: waiting(*a).withColumn("folder", F.udf(noted)("folder")))
    for day, files in enumerate((3, 2, 0)):
        for n in range(files):
            land(zones, "t", f"day{day}_{n}.jsonl", [{"id": n, "v": f"{day}"}])
        seen.value = 0
        outcome = load(spark, zones, T, days=day)
        assert (outcome.rows, outcome.status) == (files, "loaded" if files else "no new files")
        assert seen.value == files
    assert state(spark, zones, "t", "id", "v", "_latest") == [(0, "0", False), (0, "1", True), (1, "0", False), (1, "1", True), (2, "0", True)]
    assert Store(spark, zones).consumed("t").count() == 5


def folders(spark):
    return set(Path(work_dir(spark)).iterdir())


def test_a_load_leaves_no_staged_rows(spark, zones, monkeypatch):
    """Neither does a first load, in parts, nor one that finds a history."""
    monkeypatch.setattr("varve.plans.bronze.PART_BYTES", 500)
    before = folders(spark)
    for day in range(2):
        land(zones, "t", f"day{day}.jsonl", [{"id": n, "v": str(day)} for n in range(50)])
        load(spark, zones, T, day)
    assert len(state(spark, zones, "t", "id")) == 100
    assert folders(spark) == before
    assert spark.conf.get(CLEANUP) == "false"


def test_packed_csv_batches_load(spark, zones):
    rows = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "id int, v string").selectExpr("*", "'t_1' AS name")
    land_batches(rows, zones, "t", "name", "csv", codec="gzip")
    assert all(p.suffix == ".gz" for p in Path(zones.landing, "t").rglob("part-*"))
    assert load(spark, zones, TableSpec("t", "id", quote_escape='"')).rows == 2
    assert state(spark, zones, "t", "id", "v", as_text=True) == [("1", 'a "b", c'), ("2", "None")]


def test_a_tidy_write_deletes_its_shuffle_files(spark, zones):
    def files():
        local = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
        return {f.name for f in local.rglob("shuffle_*")}

    before = files()
    with tidy(spark), tidy(spark):
        assert materialize(spark.range(100).repartition(3, "id")).count() == 100
        assert files() == before
    assert spark.conf.get(CLEANUP) == "false"
    assert materialize(spark.range(100).repartition(3, "id")).count() == 100 and files() > before


def test_feedback_lands_packed_details_and_leaves_nothing_staged(spark, zones):
    ship(spark)
    spec = TableSpec("leads", "external_system_id")
    lead = {"campaign_id": "c", "lead_status": 1}
    land(zones, "leads", "a.jsonl", [{**lead, "external_system_id": str(n)} for n in range(30)])
    load(spark, zones, spec)
    before = folders(spark)
    schema = "campaign_id STRING, external_system_id STRING, seq BIGINT"
    now = CLOCK + timedelta(days=1)
    fetch = lambda key: [{"seq": n} for n in range(2)]
    assert feedback_enrich(spark, zones, "leads", "log", fetch, schema, now, "open", codec="gzip") == 60
    assert folders(spark) == before
    assert {p.suffix for p in Path(zones.landing, "log").rglob("part-*")} == {".gz"}
    assert load(spark, zones, TableSpec("log", "external_system_id", schema=schema), 1).rows == 60
