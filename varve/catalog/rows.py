"""Hashes, metadata columns, filters and nested data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.catalog.base import CLOCK, day_of, query, table
from varve.functions.hashing import record_hash, row_hash
from varve.functions.nested import has_tag, json_to_struct, unpack_envelope
from varve.functions.times import iso_utc
from varve.operators.filters import chunk, chunk_hash, recent, status_in, valid_as, worklist
from varve.operators.metadata import add_basic_metadata
from varve.operators.versioning import union_history

ORDERS_TEXT = (
    "sha256(concat_ws('|', o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice))"
)


@query(f"SELECT o_orderkey, {ORDERS_TEXT} AS row_hash FROM orders")
def row_hash_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the hash of flat rows."""
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", row_hash(orders).alias("row_hash"))


@query(
    """SELECT event_id, sha256(concat_ws('|', event_id, event_type, props, ts, user_id, value)) AS row_hash
       FROM events"""
)
def row_hash_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the hash of rows with a time and JSON text."""
    events = table(spark, sf_dir, "events")
    return events.select("event_id", row_hash(events).alias("row_hash"))


@query(
    """SELECT event_id, sha256(concat_ws('|', '{"kind":"' || event_type || '","user":' || user_id || ',"at":"'
              || strftime(moment, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}', moment, event_id,
              '[{"k":' || json_extract(props, '$.k') || '}]')) AS row_hash
       FROM (SELECT *, make_timestamp(1700000000000000 + event_id) AS moment FROM events)"""
)
def row_hash_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: structs, and arrays of them, enter the hash as JSON; moments a microsecond apart differ."""
    events = json_to_struct(table(spark, sf_dir, "events"), "props", "k BIGINT")
    moment = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("event_id"))
    nested = events.select(
        "event_id",
        F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user"), moment.alias("at")).alias("a"),
        moment.alias("b"),
        F.array("props").alias("list"),
    )
    return nested.select("event_id", row_hash(nested).alias("row_hash"))


@query(
    """SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderdate":"'
              || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '","o_orderkey":' || o_orderkey
              || ',"o_orderpriority":"' || o_orderpriority
              || CASE WHEN o_orderstatus = 'P' THEN '' ELSE '","o_orderstatus":"' || o_orderstatus END
              || '","o_totalprice":' || o_totalprice || '}') AS row_hash
       FROM orders"""
)
def row_hash_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: the hash that tells which column is null."""
    orders = table(spark, sf_dir, "orders")
    orders = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return orders.select("o_orderkey", row_hash(orders, "strict").alias("row_hash"))


@query(
    """SELECT c_custkey, sha256('{"c_acctbal":' || c_acctbal || ',"c_mktsegment":"'
              || CASE WHEN c_mktsegment = 'MACHINERY' THEN 'none' ELSE c_mktsegment END
              || '","c_nationkey":' || CAST(c_nationkey AS DOUBLE) || '}') AS record_hash
       FROM customer""",
    name="record_hash",
)
def record_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records brought to one form before they are hashed."""
    customer = table(spark, sf_dir, "customer")
    settings = customer.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    digest = record_hash(
        settings,
        ["c_nationkey", "c_mktsegment", "c_acctbal"],
        normalise={
            "c_mktsegment": F.coalesce("c_mktsegment", F.lit("none")),
            "c_nationkey": F.col("c_nationkey").cast("double"),
        },
    )
    return settings.select("c_custkey", digest.alias("record_hash"))


@query(
    f"""SELECT o_orderkey, {ORDERS_TEXT} AS _row_hash, epoch_us(TIMESTAMP '2024-02-01') AS insert_micros,
               epoch_us(TIMESTAMP '2024-02-01') AS update_micros, 'main' AS _code_version,
               'orders.parquet' AS source
        FROM orders"""
)
def basic_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5-M8: all metadata columns of a scan."""
    stamped = add_basic_metadata(table(spark, sf_dir, "orders"), CLOCK, "main")
    return stamped.select(
        "o_orderkey",
        "_row_hash",
        F.unix_micros("_bronze_insert_ts").alias("insert_micros"),
        F.unix_micros("_bronze_update_ts").alias("update_micros"),
        "_code_version",
        F.element_at(F.split("_raw_file_source", "/"), -1).alias("source"),
    )


@query(
    """SELECT c_custkey FROM customer
       WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal >= 0"""
)
def silver_valid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows whose id text reads as an integer; some are words, some out of range."""
    customer = table(spark, sf_dir, "customer")
    number = F.col("c_custkey").cast("string")
    text = (
        F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_name"))
        .when(F.col("c_acctbal") < 0, F.concat(F.lit("3000000000"), number))
        .otherwise(F.concat(F.lit(" "), number))
    )
    return valid_as(customer.withColumn("id", text), "id", "integer").select("c_custkey")


@query("SELECT doc_id, toxic FROM labels WHERE quality IN (1)")
def worklist_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows whose status is open."""
    labels = table(spark, sf_dir, "labels")
    return labels.where(status_in(F.col("quality"), "open")).select("doc_id", "toxic")


@query("SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-25'")
def worklist_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows of the last days."""
    events = table(spark, sf_dir, "events")
    return events.where(recent(events, "ts", CLOCK)).select("event_id", "event_type")


LEADS = """
    SELECT event_id, ts, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'signup' THEN 2 END AS status,
           CASE WHEN event_type = 'error' THEN '' WHEN value < 1 THEN NULL
                ELSE CAST(user_id AS VARCHAR) END AS external_id,
           json_extract_string(props, '$.k') AS campaign
    FROM events
"""


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as leads: a status, an id that may be empty or null, and a campaign."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.expr("CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'signup' THEN 2 END").alias("status"),
        F.expr(
            "CASE WHEN event_type = 'error' THEN '' WHEN value < 1 THEN NULL ELSE CAST(user_id AS STRING) END"
        ).alias("external_id"),
        F.get_json_object("props", "$.k").alias("campaign"),
    )


@query(
    f"""SELECT DISTINCT campaign, external_id FROM ({LEADS})
        WHERE (status IN (1) OR CAST(ts AS DATE) > DATE '2024-01-25') AND external_id <> ''""",
    name="worklist",
)
def open_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys to fetch details for."""
    return worklist(
        leads(spark, sf_dir), "status", "open", "ts", CLOCK, "external_id", ["campaign", "external_id"]
    )


@query("SELECT event_id FROM events WHERE json_extract_string(props, '$.k') = '42'")
def tag_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records with a nested tag."""
    events = table(spark, sf_dir, "events")
    return events.where(has_tag(F.col("props"), "$.k", "42")).select("event_id")


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct key pairs."""
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query(
    """SELECT o_custkey AS id, o_orderstatus AS status, NULL AS segment FROM orders
       UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer"""
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two shapes; a column that one lacks is null there."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_custkey AS id", "o_orderstatus AS status")
    customer = table(spark, sf_dir, "customer").selectExpr("c_mktsegment AS segment", "c_custkey AS id")
    return orders.unionByName(customer, allowMissingColumns=True)


@query(
    """SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS amount, CAST(p_size AS VARCHAR) AS code, NULL AS extra FROM part
       UNION ALL SELECT s_suppkey, s_acctbal, s_name, s_nationkey FROM supplier"""
)
def union_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History and new rows whose types and columns differ."""
    old = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_size AS amount", "p_size AS code")
    new = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "s_acctbal AS amount", "s_name AS code", "s_nationkey AS extra"
    )
    return union_history(old, new, drift="string")


@query(
    """SELECT o_orderkey, strftime(o_orderdate - INTERVAL 7 DAY, '%Y-%m-%d') AS before,
              strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS after
       FROM orders"""
)
def date_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates some days off."""
    day = day_of("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_sub(day, 7).cast("string").alias("before"),
        F.date_add(day, 30).cast("string").alias("after"),
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts FROM events")
def iso_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text form of a request's time bounds."""
    return table(spark, sf_dir, "events").select("event_id", iso_utc(F.col("ts")).alias("ts"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events", name="json_to_struct")
def json_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text to a struct whose schema is inferred."""
    return json_to_struct(table(spark, sf_dir, "events"), "props").select("event_id", "props.k")


# Rows per response body.
PAGE = 200


@query(
    f"""WITH pages AS (SELECT event_id // {PAGE} AS page, count(*) AS total, max(value) < 300 AS fine,
                             min(event_id) AS first FROM events GROUP BY 1)
        SELECT page, total, event_id, event_type, value, NULL AS reason
        FROM events JOIN pages ON event_id // {PAGE} = page
        WHERE fine AND page % 6 <> 5 AND (page % 3 <> 1 OR event_id = first)
        UNION ALL
        SELECT page, total, NULL, NULL, NULL,
               CASE WHEN fine THEN 'rows are neither an array nor an object' ELSE 'not ok' END
        FROM pages WHERE NOT fine OR page % 6 = 5""",
    name="unpack_envelope",
)
def envelope_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response bodies to rows, and the rejected ones with their reason.

    A third of the bodies holds one object instead of an array, a sixth holds a number.
    """
    bodies = (
        table(spark, sf_dir, "events")
        .groupBy(F.floor(F.col("event_id") / PAGE).alias("page"))
        .agg(
            F.count("*").alias("total"),
            (F.max("value") < 300).alias("status"),
            F.collect_list(F.struct("event_id", "event_type", "value")).alias("rows"),
        )
        .withColumn("message", F.when(F.col("status"), "Success").otherwise("Failed"))
        .withColumn("page_rows", F.to_json("rows"))
        .withColumn("first", F.to_json(F.array_min("rows")))
        .select("page", F.to_json(F.struct("status", "message", "total", F.lit("@rows").alias("rows"))).alias("body"), "page_rows", "first")
        .select(
            "page",
            F.replace(
                "body",
                F.lit('"@rows"'),
                F.when(F.col("page") % 6 == 5, "17").when(F.col("page") % 3 == 1, F.col("first")).otherwise(F.col("page_rows")),
            ).alias("body"),
        )
    )
    rows, rejected = unpack_envelope(
        bodies,
        "body",
        "rows",
        "event_id BIGINT, event_type STRING, value DOUBLE",
        envelope_schema="status BOOLEAN, message STRING, total BIGINT",
        keep=["page", "total"],
    )
    return rows.withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejected.select("page", "total", "reason"), allowMissingColumns=True
    )


@query(
    """SELECT o_orderkey, ntile(CAST((SELECT ceil(count(*) / 5000.0) FROM orders) AS BIGINT))
              OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS _chunk
       FROM orders""",
    name="chunk_ntile",
)
def chunk_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: contiguous parts of a work list, equal up to one row."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return chunk(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "_chunk")


@query("SELECT count(*) AS rows, TRUE AS in_range, TRUE AS near_equal FROM orders", name="chunk_hash")
def chunk_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: parts of a work list by a hash of the key, without a sort."""
    orders = table(spark, sf_dir, "orders")
    sizes = chunk_hash(orders, ["o_orderkey"], 8).groupBy("_chunk").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.sum("n").alias("rows"),
        F.every(F.col("_chunk").between(0, 7)).alias("in_range"),
        (F.max("n") < 2 * F.min("n")).alias("near_equal"),
    )
