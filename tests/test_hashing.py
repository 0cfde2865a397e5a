"""Row hashes: what enters, null ambiguity, nested values, odd names."""

from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from varve.functions.hashing import record_hash, row_hash


def digest(text):
    return sha256(text.encode()).hexdigest()


def hashes(df, mode="compat"):
    return [r[0] for r in df.select(row_hash(df, mode)).collect()]


def test_order_of_columns_and_metadata_do_not_matter(spark):
    df = spark.createDataFrame([("2", "1", "m")], "b string, a string, _meta string")
    assert hashes(df) == [digest("1|2")]
    assert hashes(df.select("_meta", "a", "b")) == [digest("1|2")]


def test_compat_skips_nulls_and_strict_does_not(spark):
    df = spark.createDataFrame([(None, "x", "y"), ("x", "y", None)], "a string, b string, c string")
    assert len(set(hashes(df))) == 1
    assert len(set(hashes(df, "strict"))) == 2


def test_nested_values_are_json(spark):
    df = spark.sql(
        """SELECT named_struct('x', 1, 'y', CAST(NULL AS INT)) AS a, array('p', 'q') AS b,
                  array(named_struct('z', 2)) AS c, map('k2', 2, 'k1', 1) AS d, array(1, 2) AS e,
                  array(array(1), array(2)) AS f"""
    )
    assert hashes(df) == [digest('{"x":1}|p|q|[{"z":2}]|{"k1":1,"k2":2}|1|2|[[1],[2]]')]


def test_odd_names(spark):
    df = spark.createDataFrame([("1", "2", "3")], ["a.b", "c`d", "e f"])
    assert hashes(df) == [digest("1|2|3")]
    assert len(hashes(df, "strict")) == 1


def test_strict_keeps_microseconds(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:00.000001' AS t UNION ALL SELECT timestamp'2024-01-01 00:00:00.000002'"
    )
    assert len(set(hashes(df, "strict"))) == 2


MOMENTS = """SELECT timestamp_micros(1700000000000001 + n) AS t, named_struct('x', timestamp_micros(1700000000000001 + n)) AS s,
                    array(timestamp_micros(1700000000000001 + n), NULL) AS a, map('k', timestamp_micros(n)) AS m FROM VALUES (0), (1) AS v(n)"""


@pytest.mark.parametrize("mode", ["compat", "strict"])
@pytest.mark.parametrize("column", ["t", "s", "a", "m"])
def test_times_count_in_utc_to_the_microsecond(spark, mode, column):
    found = {}
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            found[zone] = hashes(spark.sql(MOMENTS).select(column), mode)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found["UTC"] == found["America/New_York"] and len(set(found["UTC"])) == 2


def test_text_of_times_is_that_of_a_session_in_utc(spark):
    df = spark.sql("SELECT timestamp'2024-01-02 03:04:05.120' AS t UNION ALL SELECT timestamp'1969-12-31 23:59:59.999999' UNION ALL SELECT timestamp'0044-03-15 00:00:00'")
    assert hashes(df) == [digest(r[0]) for r in df.selectExpr("CAST(t AS string)").collect()]


def test_map_order_does_not_matter_to_records(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('b', 2, 'a', 1)")
    assert df.select(record_hash(df)).distinct().count() == 1


def test_field_order_does_not_matter_to_records(spark):
    one = "named_struct('b', array(named_struct('d', 1, 'c', 2)), 'a', map('k', named_struct('y', 1, 'x', 2)))"
    two = "named_struct('a', map('k', named_struct('x', 2, 'y', 1)), 'b', array(named_struct('c', 2, 'd', 1)))"
    first, second, missing = (
        df.select(record_hash(df)).first()[0]
        for df in (spark.sql(f"SELECT {value} AS r, 1 AS n") for value in (one, two, f"if(rand() < 0, {one}, NULL)"))
    )
    assert first == second
    assert missing == digest('{"n":1}')


def test_record_normalised(spark):
    df = spark.sql("SELECT 1 AS bid, CAST(NULL AS STRUCT<u: STRING>) AS hooks")
    same = spark.sql("SELECT 1.0D AS bid, named_struct('u', CAST(NULL AS STRING)) AS hooks")
    fixed = {
        "bid": F.col("bid").cast("double"),
        "hooks": F.coalesce("hooks", F.struct(F.lit(None).cast("string").alias("u"))),
    }
    assert df.select(record_hash(df, normalise=fixed)).first() == same.select(record_hash(same)).first()


def test_unknown_names_and_modes(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="nope"):
        record_hash(df, ["nope"])
    with pytest.raises(ValueError, match="mode"):
        row_hash(df, "fast")
