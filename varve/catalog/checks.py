"""Keyed sources, landed listings, and the totals they are checked against."""

from __future__ import annotations

from datetime import datetime
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.catalog.base import fresh_zones, micros_text, query, table
from varve.functions.json_paths import json_paths, split_malformed
from varve.functions.nested import json_to_struct
from varve.operators.filters import extract_gaps
from varve.operators.quality import listing_complete, totals
from varve.operators.reconcile import row_differences
from varve.sources.fetch import fetch_by_key
from varve.sources.files import land_jsonl, read_jsonl


@query(
    """WITH t AS (SELECT conv_id, CAST(turn // 2 + 1 AS BIGINT) AS page FROM conversations),
            s AS (SELECT conv_id, max(page) AS total_pages, count(*) AS total_record FROM t GROUP BY conv_id),
            k AS (SELECT * FROM t JOIN s USING (conv_id)
                  WHERE NOT (total_record % 3 = 0 AND total_pages > 1 AND page = total_pages))
       SELECT 'turns:' || conv_id AS listing, total_pages AS declared_pages, count(DISTINCT page) AS found_pages,
              total_record AS declared, count(*) AS received,
              count(DISTINCT page) = total_pages AND count(*) = total_record AS ok
       FROM k GROUP BY conv_id, total_pages, total_record
       UNION ALL SELECT DISTINCT 'notes:' || conv_id, NULL, 0, NULL, 0, TRUE FROM conversations""",
    name="listing_complete",
)
def landed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed response bodies of listings; a third lost their last page, half are empty."""
    turns = table(spark, sf_dir, "conversations").withColumn("page", F.floor(F.col("turn") / 2) + 1)
    told = turns.groupBy("conv_id").agg(F.max("page").alias("total_pages"), F.count("*").alias("total_record"))
    pages = turns.groupBy("conv_id", "page").agg(F.collect_list(F.struct("turn", "role")).alias("rows"))
    lost = (F.col("total_record") % 3 == 0) & (F.col("total_pages") > 1) & (F.col("page") == F.col("total_pages"))
    whole = F.to_json(F.struct("total_pages", "total_record", "rows"))
    bodies = pages.join(told, "conv_id").where(~lost).select(
        F.concat(F.lit("turns:"), "conv_id").alias("listing"), "page", whole.alias("body")
    )
    empty = told.select(
        F.concat(F.lit("notes:"), "conv_id").alias("listing"),
        F.lit(1).cast("long").alias("page"),
        F.lit('{"message": "No records found"}').alias("body"),
    )
    zones = fresh_zones(spark, "listings")
    land_jsonl(bodies.union(empty), zones, "listings", "bodies")
    landed = read_jsonl(spark, f"{zones.landing}/listings/bodies.jsonl", "listing STRING, page BIGINT, body STRING")
    envelope = "message STRING, total_pages BIGINT, total_record BIGINT, rows ARRAY<STRUCT<turn: INT, role: STRING>>"
    opened = json_to_struct(landed, "body", envelope).select(
        "listing", "page", "body.message", "body.total_pages", "body.total_record",
        F.coalesce(F.size("body.rows"), F.lit(0)).alias("received"),
    )
    return listing_complete(opened, "listing")


def details(key: dict) -> dict | list[dict]:
    """Detail rows of a key: one object, or a list for larger account numbers."""
    number = str(key["c_custkey"])
    rows = [
        {"seq": n, "digest": sha256(f"{number}|{key['c_nationkey']}|{n}".encode()).hexdigest()}
        for n in range(len(number))
    ]
    return rows[0] if len(rows) == 1 else rows


@query(
    """SELECT c_custkey, c_nationkey, seq, sha256(c_custkey || '|' || c_nationkey || '|' || seq) AS digest
       FROM (SELECT c_custkey, c_nationkey, unnest(range(length(CAST(c_custkey AS VARCHAR)))) AS seq FROM customer)""",
    name="fetch_by_key",
)
def customer_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail rows fetched per key."""
    keys = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return fetch_by_key(keys, details, "c_custkey BIGINT, c_nationkey INT, seq BIGINT, digest STRING")


@query(
    """SELECT conv_id, max(turn) + 1 AS declared, count(*) AS received, max(turn) + 1 = count(*) AS ok
       FROM conversations GROUP BY conv_id""",
    name="assert_total",
)
def turn_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: rows received against the total each source declares."""
    turns = table(spark, sf_dir, "conversations")
    declared = turns.select("conv_id", (F.col("turn") + 1).alias("total"))
    return totals(turns, declared, "conv_id", "total")


LANDED = """
    WITH sent AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
         landed AS (SELECT o_orderkey, CASE WHEN o_orderkey % 89 = 3 THEN NULL ELSE o_custkey END AS o_custkey,
                           o_orderstatus, o_totalprice
                    FROM sent, (VALUES (1), (2)) AS times(n)
                    WHERE o_orderkey % 97 <> 5 AND (n = 1 OR o_orderkey % 83 = 1))
"""


@query(
    f"""{LANDED}
       SELECT 'extracted' AS side, *, 1 AS copies FROM (SELECT * FROM sent EXCEPT ALL SELECT * FROM landed)
       UNION ALL
       SELECT 'landed', *, 1 FROM (SELECT * FROM landed EXCEPT ALL SELECT * FROM sent)"""
)
def content_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: rows lost, changed and doubled between an extract and what landed of it."""
    sent = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    times = F.explode(F.when(F.col("o_orderkey") % 83 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    damaged = sent.where("o_orderkey % 97 <> 5").select("*", times.alias("n")).drop("n")
    damaged = damaged.withColumn("o_custkey", F.when(F.col("o_orderkey") % 89 != 3, F.col("o_custkey")))
    zones = fresh_zones(spark, "reconcile")
    land_jsonl(damaged, zones, "orders", "orders")
    landed = read_jsonl(spark, f"{zones.landing}/orders/orders.jsonl", sent.schema).select(*sent.columns)
    found = row_differences(sent, landed, names=("extracted", "landed"))
    return found.withColumn("copies", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))


@query(
    """WITH bounds AS (SELECT TIMESTAMP '2024-01-02 00:00:00' AS low, TIMESTAMP '2024-01-28 12:00:00' AS high),
            held AS (SELECT event_type, greatest(ts, low) AS a, least(ts + to_seconds(event_id % 120 * 60), high) AS b
                     FROM events, bounds WHERE event_id % 3 <> 0),
            all_of AS (SELECT event_type, a, b FROM held WHERE b > a
                       UNION ALL SELECT DISTINCT event_type, low, low FROM events, bounds WHERE event_id % 3 <> 0
                       UNION ALL SELECT DISTINCT event_type, high, high FROM events, bounds WHERE event_id % 3 <> 0),
            run AS (SELECT event_type, a, max(b) OVER (PARTITION BY event_type ORDER BY a, b
                                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM all_of)
       SELECT event_type, strftime(upto, '%Y-%m-%d %H:%M:%S.%f') AS gap_start, strftime(a, '%Y-%m-%d %H:%M:%S.%f') AS gap_end
       FROM run WHERE a > upto""",
    name="extract_gaps",
)
def missing_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The times of each object that no extract window covered."""
    events = table(spark, sf_dir, "events").where("event_id % 3 <> 0")
    end = F.timestamp_add("MINUTE", (F.col("event_id") % 120).cast("int"), F.col("ts"))
    windows = events.select("event_type", "ts", end.alias("until"))
    gaps = extract_gaps(windows, "event_type", "ts", "until", datetime(2024, 1, 2), datetime(2024, 1, 28, 12))
    return gaps.select("event_type", *[micros_text(c).alias(c) for c in ("gap_start", "gap_end")])


# Events whose text was damaged: a tenth is cut short, a tenth has other kinds and deeper values.
_DEEP = '{"k": "x", "deep": {"a.b": [1, null, 2.5, [true]], "none": {}}}'
DAMAGED = f"""SELECT event_id, CASE event_id % 10 WHEN 0 THEN left(props, length(props) - 1)
                     WHEN 1 THEN '{_DEEP}' WHEN 2 THEN NULL ELSE props END AS props FROM events"""


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.expr("left(props, length(props) - 1)")
    kind = F.col("event_id") % 10
    text = F.when(kind == 0, cut).when(kind == 1, F.lit(_DEEP)).when(kind != 2, F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", text.alias("props"))


@query(
    f"""WITH d AS (SELECT event_id % 10 AS r FROM ({DAMAGED}))
        SELECT path, kind, count(*) AS "count" FROM d, (VALUES ('$', 'malformed', 0, 0), ('$', 'object', 1, 1), ('$', 'object', 3, 9),
            ('$.k', 'integer', 3, 9), ('$.k', 'string', 1, 1), ('$.deep', 'object', 1, 1), ('$.deep.a.b', 'array', 1, 1),
            ('$.deep.none', 'object', 1, 1), ('$.deep.a.b[]', 'integer', 1, 1), ('$.deep.a.b[]', 'null', 1, 1),
            ('$.deep.a.b[]', 'number', 1, 1), ('$.deep.a.b[]', 'array', 1, 1), ('$.deep.a.b[][]', 'boolean', 1, 1))
            AS found(path, kind, low, high) WHERE r BETWEEN low AND high GROUP BY path, kind""",
    name="json_paths",
)
def paths_of_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every path of a damaged JSON column, with kinds and counts."""
    return json_paths(_damaged(spark, sf_dir), "props").select("path", "kind", "count")


@query(
    f"""SELECT event_id, CASE WHEN event_id % 10 = 1 THEN 'x' ELSE json_extract_string(props, '$.k') END AS k, event_id % 10 = 1 AS deep, FALSE AS broken
        FROM ({DAMAGED}) WHERE event_id % 10 <> 0
        UNION ALL SELECT event_id, NULL, FALSE, TRUE FROM events WHERE event_id % 10 = 0"""
)
def json_kept_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A damaged JSON column as structs, a path of two kinds as text, and its broken rows kept."""
    good, bad = split_malformed(_damaged(spark, sf_dir), "props")
    opened = json_to_struct(good, "props").select("event_id", "props.k", F.col("props.deep").isNotNull().alias("deep"), F.lit(False).alias("broken"))
    return opened.union(bad.select("event_id", F.lit(None).cast("string"), F.lit(False), F.lit(True)))
