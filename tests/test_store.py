"""Stored tables: generations, buckets, commits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from varve.sources.store import Store, read_path_or_none
from varve.spec import Zones


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, Zones(str(tmp_path), "s"), buckets=4)


def test_missing_table_is_none(spark, store, tmp_path):
    assert store.read_or_none("t") is None
    assert store.consumed("t").count() == 0
    with pytest.raises(FileNotFoundError):
        store.read("t")
    assert read_path_or_none(spark, f"{tmp_path}/nothing") is None
    put = f"{tmp_path}/there"
    spark.range(3).write.parquet(put)
    assert read_path_or_none(spark, put).count() == 3
    with pytest.raises(Exception, match="nosuchformat"):
        read_path_or_none(spark, put, "nosuchformat")


def test_replace_from_itself(spark, store):
    store.replace(spark.range(10), "t")
    store.replace(store.read("t").where("id < 4").withColumn("x", F.lit("new")), "t")
    assert store.read("t").count() == 4 and store.read("t").columns == ["id", "x"]
    assert store.commit_of("t").version == 2 and store.tables() == ["t"]


def test_replace_some_buckets(spark, store):
    first = store.replace(spark.range(100).withColumn("v", F.lit(0)), "t", key=["id"])
    assert first.rows == 100 and len(first.parts) == 4
    changed = store.read("t").where("id IN (3, 5)")
    touched = store.touched("t", changed)
    part = store.read_or_none("t", touched)
    new = part.withColumn("v", F.when(F.col("id").isin(3, 5), 1).otherwise(F.col("v"))).withColumn(
        "extra", F.lit("e")
    )
    second = store.replace_buckets(new, "t", touched)
    written = {b for b in range(4) if second.open_buckets()[b] != first.open_buckets()[b]}
    assert written == set(touched)
    rows = store.read("t").collect()
    assert len(rows) == 100 and sum(r["v"] for r in rows) == 2
    assert {r["extra"] for r in rows} == {None, "e"}


def test_emptied_bucket_goes(spark, store):
    store.replace(spark.range(100), "t", key=["id"])
    store.replace_buckets(store.read_or_none("t", [0, 1]).where("id < 0"), "t", [0, 1])
    assert set(store.commit_of("t").open_buckets()) == {2, 3}
    assert store.read_or_none("t", [0]).count() == 0


def test_empty_table(spark, store):
    store.replace(spark.range(0), "t", key=["id"])
    assert store.read("t").count() == 0 and store.read("t").columns == ["id"]


def test_null_and_widened_keys_keep_their_bucket(spark, store):
    store.replace(spark.sql("SELECT CAST(NULL AS INT) AS id UNION ALL SELECT 7"), "t", key=["id"])
    wide = spark.sql("SELECT CAST(NULL AS BIGINT) AS id UNION ALL SELECT 7L")
    assert set(store.touched("t", wide)) == set(store.commit_of("t").open_buckets())


def test_write_without_commit_changes_nothing(spark, store, monkeypatch):
    store.replace(spark.range(5), "t")
    folder = type(store._commits("t"))
    with monkeypatch.context() as patch:
        patch.setattr(folder, "create", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            store.replace(spark.range(9), "t")
    assert store.read("t").count() == 5 and store.commit_of("t").version == 1


def test_second_writer_of_a_version_fails(spark, store):
    store.replace(spark.range(5), "t")
    commit = store.commit_of("t")
    with pytest.raises(RuntimeError, match="another writer"):
        store._commits("t").create("00000001.json", commit.to_json())


def test_buckets_need_a_key(spark, store):
    store.replace(spark.range(5), "t")
    with pytest.raises(ValueError, match="buckets"):
        store.replace_buckets(spark.range(1), "t", [0])


def test_closed_rows_are_added_to_and_compacted(spark, store):
    rows = spark.range(40).selectExpr("id", "id < 30 AS open", "0 AS v")
    first = store.replace(rows, "t", key=["id"], split="open")
    assert store.read_or_none("t", is_open=True).count() == 30
    assert store.read_or_none("t", is_open=False).count() == 10
    everywhere = range(4)
    # Ten open rows close; the closed ones that were there stay where they are.
    changed = store.read_or_none("t", is_open=True).selectExpr("id", "id < 20 AS open", "1 AS v")
    second = store.replace_buckets(changed, "t", everywhere)
    assert second.rows == 30 and store.read("t").count() == 40
    assert store.read_or_none("t", is_open=False).where("v = 0").count() == 10
    assert all(set(g) <= set(second.parts[p]) for p, g in first.parts.items() if "false" in p)
    whole = store.read("t")
    third = store.replace_buckets(whole, "t", everywhere, compact=everywhere)
    assert all(len(g) == 1 for g in third.parts.values()) and store.read("t").count() == 40
    assert store.read("t").columns == ["id", "open", "v"]
