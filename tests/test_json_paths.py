"""Paths of JSON text against a plain walk."""

from __future__ import annotations

import json
from collections import Counter

from varve.functions.json_paths import json_paths, schema_of_paths, split_malformed
from varve.functions.nested import json_to_struct

TEXTS = [
    '{"a": 1, "b": {"c.d": [1, 2.5, "x", null, {"e": true}], "f": []}}',
    '{"a": "one", "OBJECT<": {" VOID": null}}',
    '{"a": null}',
    "[1, [2]]",
    "7",
    "null",
    '{"cut": ',
    "",
    None,
    '{"big": 123456789012345678901234567890, "exp": 1e3}',
]


def walk(value, steps=()):
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null", int: "integer", float: "number"}[type(value)]
    if kind == "integer" and abs(value) >= 1 << 63:
        kind = "number"
    yield steps, kind
    if isinstance(value, dict):
        for key, inner in value.items():
            yield from walk(inner, (*steps, f".{key}"))
    if isinstance(value, list):
        for inner in value:
            yield from walk(inner, (*steps, "[]"))


def plain(texts):
    found = Counter()
    for text in texts:
        if text is None:
            continue
        try:
            found.update(walk(json.loads(text)))
        except json.JSONDecodeError:
            found[(), "malformed"] += 1
    return found


def test_paths_equal_a_plain_walk(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "__value string")
    found = {(tuple(r["steps"]), r["kind"]): r["count"] for r in json_paths(df, "__value").collect()}
    assert found == plain(TEXTS)
    assert json_paths(df.limit(0), "__value").count() == 0
    assert {len(r["steps"]) for r in json_paths(df, "__value", depth=2).collect()} == {0, 1}


def test_broken_rows_are_kept_apart(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "n int, t string")
    good, bad = split_malformed(df, "t")
    assert [r["n"] for r in bad.orderBy("n").collect()] == [6, 7] and good.count() == 8


def test_schemas_follow_the_kinds(spark):
    def schema(*texts):
        return schema_of_paths([(list(s), k) for s, k in plain(texts)]).simpleString()

    assert schema('{"a": 1, "b": [1, 2.5]}', '{"a": null, "c": {"d": true}}') == "struct<a:bigint,b:array<double>,c:struct<d:boolean>>"
    assert schema('{"a": 1}', '{"a": "x"}', '{"a": {"b": 1}}') == "struct<a:string>"
    assert schema('{"a": null, "b": {}, "c": []}') == "struct<a:string,b:string,c:array<string>>"
    assert schema() == "string"
    df = spark.createDataFrame([('{"OBJECT<": {" VOID": 1}, "x.y": [true]}',)], "t string")
    assert json_to_struct(df, "t").first()["t"].asDict(True) == {"OBJECT<": {" VOID": 1}, "x.y": [True]}
