"""Physical plans: pruning, pushdown, skew, no Python and no windows in the core."""

from __future__ import annotations

import re
from contextlib import contextmanager
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from varve.functions.hashing import row_hash
from varve.operators.filters import extract_window, project_fields, recent
from varve.operators.versioning import FLAGS, add_version_flags, latest, upsert_versions
from varve.plans.silver import silver_view
from varve.session import work_dir
from varve.sources.store import Store
from varve.spec import Zones

SF_DIR = "/root/testdata/sf0.01"
CLOCK = datetime(2024, 2, 1, tzinfo=timezone.utc)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    old = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


def feed(spark):
    df = events(spark).withColumn("day", F.to_date("ts"))
    return df.withColumn("_row_hash", row_hash(df.select("user_id", "event_type")))


def test_windows_are_pushed_to_the_scan(spark):
    text = plan(extract_window(events(spark), "ts", "2024-01-10", 7, ["event_id"], allowed=["ts"]))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    df = events(spark)
    text = plan(df.where(recent(df, "ts", CLOCK)).select("event_id"))
    assert "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_named_fields_are_all_that_is_read(spark):
    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    text = plan(project_fields(lineitem, ["l_orderkey", "l_tax"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in text


def test_flags_read_three_columns_and_shuffle_rows_once(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(add_version_flags(feed(spark), "user_id", ts="day"))
    assert "Window" not in text and "Python" not in text
    wide = re.findall(r"Exchange\nInput \[\d+\]: \[event_id", text)
    assert len(wide) == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_small_upsert_does_not_shuffle_history(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        df = add_version_flags(feed(spark), "user_id", ts="day")
        path = f"{work_dir(spark)}/plan-history"
        df.write.mode("overwrite").parquet(path)
        history, new = spark.read.parquet(path), feed(spark).where("event_id < 100")
        text = plan(upsert_versions(history, new, "user_id", ts="day", new_rows=100))
    assert "SortMergeJoin" not in text and "Window" not in text
    assert not re.findall(r"Exchange\nInput \[\d+\]: \[event_id", text)


@pytest.mark.parametrize("counted", [True, False])
def test_upsert_finds_the_times_of_keys_once(spark, counted):
    """Scans of history: for times by key, for hashes, for whole rows. New rows: twice for each of the
    first two, once for pairs of key and hash, once for whole rows."""
    df = add_version_flags(feed(spark), "user_id", ts="day")
    paths = [f"{work_dir(spark)}/plan-{name}-{counted}" for name in ("old", "new")]
    for path in paths:
        df.write.parquet(path)
    history, new = (spark.read.parquet(path) for path in paths)
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        merged = upsert_versions(history, new.drop(*FLAGS), "user_id", ts="day", new_rows=1000 if counted else None)
        text = merged._jdf.queryExecution().executedPlan().toString()
    assert [len(re.findall(rf"FileScan .*{re.escape(path[-30:])}", text)) for path in paths] == [3, 6]


def test_latest_has_no_window(spark):
    text = plan(latest(feed(spark), "user_id", "day"))
    assert "Window" not in text and "LeftSemi" in text


def executed(df):
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("method", ["flags", "latest", "upsert"])
def test_hot_keys_are_split(spark, method):
    """A key with half of all rows: its join partition is split into several tasks."""
    rows = spark.range(400_000, numPartitions=16).select(
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 1000).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        (F.col("id") % 5).alias("day"),
    )
    rows = rows.withColumn("_row_hash", F.sha2(F.concat_ws("|", F.col("k"), F.col("day")), 256))
    path = f"{work_dir(spark)}/hot-{method}"
    rows.write.parquet(path)
    df = spark.read.parquet(path)
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="256KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="512KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        if method == "flags":
            result = add_version_flags(df, "k", ts="day")
        elif method == "latest":
            result = latest(df, "k", "day")
        else:
            old = add_version_flags(df.where("day < 4"), "k", ts="day")
            written = f"{path}-old"
            old.write.parquet(written)
            new = df.where("day = 4")
            result = upsert_versions(spark.read.parquet(written), new, "k", ts="day")
        text = executed(result.repartition(3))
    assert "skew=true" in text


def test_silver_reads_only_wanted_buckets(spark, tmp_path):
    store = Store(spark, Zones(str(tmp_path), "s"), buckets=8)
    flagged = add_version_flags(feed(spark), "user_id", ts="day")
    store.replace(flagged, "t", key=["user_id"], split="_latest")
    whole, part = store.read("t"), store.read_or_none("t", [1])
    current = store.read_or_none("t", [1], is_open=True)
    assert len(current.inputFiles()) < len(part.inputFiles()) < len(whole.inputFiles())
    assert re.search(r"PartitionFilters: \[.*_latest", plan(silver_view(whole)))


def test_hot_bucket_is_written_as_several_files(spark, tmp_path):
    hot = spark.range(200_000).select(F.lit(1).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    store = Store(spark, Zones(str(tmp_path), "s"), buckets=4)
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="1MB"):
        store.replace(hot.repartition(8), "t", key=["k"])
    assert len(store.commit_of("t").parts) == 1
    assert len(store.read("t").inputFiles()) > 3
    assert store.read("t").count() == 200_000
