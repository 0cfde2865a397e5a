"""Filters, chunks, nested data, diffs and run states on small tables."""

from __future__ import annotations

from datetime import date, datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from varve.functions.nested import inferred_schema, json_to_struct, reject_any, unpack_envelope
from varve.operators.diff import duplicates, require_unique, table_diff
from varve.operators.filters import chunk, extract_window, project_fields, recent, status_in, worklist
from varve.operators.runs import latest_run, run_gate

CLOCK = datetime(2024, 2, 8, 1, tzinfo=timezone.utc)


@pytest.mark.parametrize("size, rows", [(3, 10), (5, 10), (10, 10), (4, 1), (7, 100)])
def test_chunks_are_those_of_array_split(spark, size, rows):
    df = spark.range(rows).repartition(5)
    found = {}
    for r in chunk(df, ["id"], size).collect():
        found.setdefault(r["_chunk"], []).append(r["id"])
    expected = np.array_split(np.arange(rows), -(-rows // size))
    assert [sorted(found[c]) for c in sorted(found)] == [list(part) for part in expected]


def test_no_rows_no_chunk(spark):
    assert chunk(spark.range(0), ["id"]).count() == 0


def test_recent_is_strict_by_day(spark):
    df = spark.sql(
        """SELECT explode(array(timestamp'2024-02-01 23:59:59', timestamp'2024-02-02 00:00:00', NULL)) AS ts"""
    )
    assert [r["ts"].day for r in df.where(recent(df, "ts", CLOCK)).collect()] == [2]
    by_definition = df.where(F.to_date("ts") > F.lit(date(2024, 2, 1)))
    assert by_definition.collect() == df.where(recent(df, "ts", CLOCK)).collect()


def test_worklist_with_text_status(spark):
    df = spark.createDataFrame(
        [
            ("1", "c", "x", "2020-01-01"),
            ("0", "c", "y", "2020-01-01"),
            ("0", "c", "z", "2024-02-05"),
            ("n/a", "c", "w", "2024-02-05"),
            (None, "c", "v", "2020-01-01"),
            ("1", "c", "", "2024-02-05"),
            ("1", "c", None, "2024-02-05"),
            ("1", "c", "x", "2024-02-05"),
        ],
        "status string, campaign string, id string, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    found = worklist(df, "status", "open", "ts", CLOCK, "id", ["campaign", "id"])
    assert sorted(r["id"] for r in found.collect()) == ["w", "x", "z"]
    with pytest.raises(ValueError, match="status"):
        status_in(F.col("status"), "pending")


def test_window_and_fields_are_checked(spark):
    df = spark.createDataFrame([(1, 2)], ["a.b", "c"])
    assert project_fields(df, ["a.b"]).columns == ["a.b"]
    with pytest.raises(ValueError, match="nope"):
        project_fields(df, ["c", "nope"])
    with pytest.raises(ValueError, match="createdAt"):
        extract_window(df, "c", "2024-01-01")


def test_json_schema_is_inferred(spark):
    df = spark.createDataFrame(
        [('{"a":1,"b":{"c":["x"]}}',), ('{"a":2.5,"d":null}',), ("{broken",), (None,)], "j string"
    )
    schema = inferred_schema(df, "j")
    assert set(schema.names) == {"a", "b", "d"}
    rows = json_to_struct(df, "j").select("j.a", "j.b.c").collect()
    assert [(None if r["a"] is None else float(r["a"]), r["c"]) for r in rows] == [
        (1.0, ["x"]),
        (2.5, None),
        (None, None),
        (None, None),
    ]
    with pytest.raises(ValueError, match="no JSON objects"):
        json_to_struct(spark.createDataFrame([("[1]",)], "j string"), "j")


def test_envelopes(spark):
    bodies = spark.createDataFrame(
        [
            (1, '{"status":true,"message":"Success","result":[{"id":1},{"id":2}]}'),
            (2, '{"status":true,"message":"Success","result":[]}'),
            (3, '{"status":false,"message":"Success","result":[{"id":3}]}'),
            (4, '{"status":true,"message":"no","result":[{"id":4}]}'),
            (5, '{"status":true,"message":"Success","errors":["e"],"result":[{"id":5}]}'),
            (6, "not json"),
            (7, '{"status":true,"message":"Success","warnings":["w"],"result":[{"id":7}]}'),
        ],
        "page int, body string",
    )
    rows, rejected = unpack_envelope(bodies, "body", "result", "id long", keep=["page"])
    assert sorted((r["page"], r["id"]) for r in rows.collect()) == [(1, 1), (1, 2), (7, 7)]
    assert sorted(r["page"] for r in rejected.collect()) == [3, 4, 5, 6]
    with pytest.raises(ValueError):
        reject_any(rejected)
    reject_any(rejected.where("page > 9"))


def test_diff(spark):
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), (None, "4")], "k string, h string")
    old = spark.createDataFrame(
        [("a", "1", 10), ("b", "x", 20), ("d", "5", 30), (None, None, 40)], "k string, h string, id int"
    )
    found = {(r["k"], r["change"], r["id"]) for r in table_diff(new, old, "k", "h", "id").collect()}
    assert found == {
        ("a", "unchanged", 10),
        ("b", "update", 20),
        ("c", "add", None),
        ("d", "remove", 30),
        (None, "update", 40),
    }


def test_names_must_be_unique(spark):
    df = spark.createDataFrame([("Job",), ("job",), ("other",)], "name string")
    assert [(r["name"], r["n"]) for r in duplicates(df, "name").collect()] == [("job", 2)]
    with pytest.raises(ValueError, match="job"):
        require_unique(df, "name")
    require_unique(df.where("name <> 'Job'"), "name")


STATES = "life_cycle_state string, result_state string"


@pytest.mark.parametrize(
    "states, gate",
    [
        ([], "release"),
        ([("TERMINATED", "SUCCESS")], "release"),
        ([("TERMINATED", "SUCCESS"), ("RUNNING", None)], "wait"),
        ([("RUNNING", None), ("SKIPPED", None)], "error_failed"),
        ([("NEVER_RUN", None)], "error_failed"),
        ([("INTERNAL_ERROR", "FAILED"), ("RUNNING", "SUCCESS")], "error_unknown"),
        ([(None, None), ("TERMINATED", "FAILED")], "error_unknown"),
    ],
)
def test_gate(spark, states, gate):
    assert run_gate(spark.createDataFrame(states, STATES)).first()["gate"] == gate


def test_latest_run(spark):
    jobs = spark.createDataFrame([(1,), (2,), (3,)], "job int")
    runs = spark.createDataFrame(
        [
            (1, 1, 10, "TERMINATED", "FAILED"),
            (1, 2, 20, "RUNNING", None),
            (2, 3, 10, "TERMINATED", "FAILED"),
            (2, 4, 10, "TERMINATED", "SUCCESS"),
            (9, 5, 10, "TERMINATED", "SUCCESS"),
        ],
        f"of int, run int, ts int, {STATES}",
    )
    found = {r["job"]: (r[1], r[2]) for r in latest_run(jobs, runs, "job", "of", "ts", "run").collect()}
    assert found == {1: ("RUNNING", None), 2: ("TERMINATED", "SUCCESS"), 3: ("NEVER_RUN", None)}
