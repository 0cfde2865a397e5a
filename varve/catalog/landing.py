"""Scans of landing files, manifests and landing writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.catalog.base import (
    CLOCK,
    daily_feed,
    fresh_zones,
    micros_text,
    query,
    table,
)
from varve.functions.times import batch_id, batch_names, lookback
from varve.operators.filters import extract_window, project_fields
from varve.operators.metadata import SOURCE, batch_of, stamp_batches
from varve.operators.quality import CORRUPT, formats, reconcile, split_corrupt, verify_checksums
from varve.session import fresh_dir, materialize
from varve.sources.digests import list_files, verify_files
from varve.sources.files import (
    land_batches,
    land_jsonl,
    manifest,
    new_files,
    read_csv,
    read_jsonl,
    route_files,
)

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
EVENTS_SQL = (
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props "
    "FROM events"
)


def event_rows(df: DataFrame) -> DataFrame:
    return df.select("event_id", micros_text("ts").alias("ts"), "user_id", "event_type", "value", "props")


@query(EVENTS_SQL)
def scan_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with a given schema."""
    zones = fresh_zones(spark, "scan")
    land_jsonl(table(spark, sf_dir, "events"), zones, "events", batch_id("events", CLOCK))
    return event_rows(read_jsonl(spark, f"{zones.landing}/events/*", EVENTS))


# Turns per line: a conversation of any length makes lines of bounded size.
TURNS = 50


@query("SELECT conv_id, turn, role, text FROM conversations")
def scan_jsonl_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines that hold an array of rows each."""
    turns = table(spark, sf_dir, "conversations")
    lines = (
        turns.groupBy("conv_id", F.floor(F.col("turn") / TURNS))
        .agg(F.collect_list(F.struct("conv_id", "turn", "role", "text")).alias("turns"))
        .select(F.to_json("turns").alias("value"))
    )
    path = fresh_dir(spark, "arrays")
    lines.write.text(path)
    rows, _ = split_corrupt(read_jsonl(spark, path, turns.schema))
    return rows.drop(SOURCE)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: CSV whose quoted text has line breaks and doubled quotes, a file read by many tasks."""
    documents = table(spark, sf_dir, "documents")
    zones = fresh_zones(spark, "scan")
    land_batches(documents.withColumn("name", F.lit("documents")), zones, "documents", "name", "csv")
    path = f"{zones.landing}/documents/batch=documents.csv"
    read = read_csv(spark, path, documents.schema, quote_escape='"', multiline=True, block_bytes=1 << 20)
    return read.drop(SOURCE, CORRUPT)


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
              l_discount, l_tax, l_returnflag, l_linestatus,
              strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
       FROM lineitem"""
)
def scan_csv_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV of text columns, cast afterwards."""
    lineitem = table(spark, sf_dir, "lineitem")
    zones = fresh_zones(spark, "scan")
    dated = lineitem.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    land_batches(dated.withColumn("name", F.lit("lineitem")), zones, "lineitem", "name", "csv")
    text = read_csv(spark, f"{zones.landing}/lineitem/batch=lineitem.csv")
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in dated.schema])


@query(
    """SELECT DISTINCT 'events' AS "table", strftime(ts, 'events_%Y%m%d.jsonl') AS batch,
              'jsonl' AS ext, TRUE AS has_bytes
       FROM events"""
)
def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches that wait in a landing zone."""
    zones = fresh_zones(spark, "manifest")
    feed = daily_feed(spark, sf_dir)
    land_batches(feed, zones, "events", "name")
    return (
        manifest(spark, zones.landing)
        .groupBy("table", "batch", "ext")
        .agg((F.sum("length") > 0).alias("has_bytes"))
    )


@query(
    """SELECT CAST(o_custkey AS VARCHAR) AS "table",
              CASE WHEN count(DISTINCT o_orderstatus = 'F') = 2 THEN 'csv,jsonl'
                   WHEN bool_or(o_orderstatus = 'F') THEN 'csv' ELSE 'jsonl' END AS formats,
              count(DISTINCT o_orderstatus = 'F') = 1 AS ok
       FROM orders GROUP BY o_custkey"""
)
def mixed_format_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table folders that hold more than one file format."""
    files = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("table"),
        F.when(F.col("o_orderstatus") == "F", "csv").otherwise("jsonl").alias("ext"),
    )
    return formats(files).withColumn("formats", F.array_join("formats", ","))


OFFERED = """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 'Transactions' WHEN 'O' THEN 'Declines' ELSE 'Refunds' END
           || '_' || CASE WHEN o_orderpriority < '3' THEN strftime(o_orderdate, '%Y-%m-%d')
                          ELSE strftime(o_orderdate, '%Y%m%d') END
           || CASE WHEN o_orderpriority = '5-LOW' THEN '_01-02-03' ELSE '' END || '.csv' AS name
    FROM orders
"""


@query(
    f"""SELECT o_orderkey, name, regexp_matches(name, '^(Transactions|Declines)') AS matched,
               nullif(regexp_extract(name, '^(Transactions|Declines)_', 1), '') AS "table",
               CASE WHEN regexp_matches(name, '^(Transactions|Declines)') THEN strftime(strptime(
                 replace(regexp_extract(name, '_([0-9-]+)', 1), '-', ''), '%Y%m%d'), '%Y-%m-%d') END AS date,
               CASE WHEN regexp_matches(name, '^(Transactions|Declines)')
                 THEN nullif(regexp_extract(name, '_([0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}})[.]csv$', 1), '') END AS time
        FROM ({OFFERED})""",
    name="route_files",
)
def route_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files sorted to tables by their names."""
    kind = F.expr(
        "CASE o_orderstatus WHEN 'F' THEN 'Transactions' WHEN 'O' THEN 'Declines' ELSE 'Refunds' END"
    )
    day = F.when(
        F.col("o_orderpriority") < "3", F.date_format("o_orderdate", "yyyy-MM-dd")
    ).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    time = F.when(F.col("o_orderpriority") == "5-LOW", "_01-02-03").otherwise("")
    names = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(kind, F.lit("_"), day, time, F.lit(".csv")).alias("name")
    )
    routed, unmatched = route_files(names)
    parts = routed.withColumn("matched", F.lit(True)).withColumn("date", F.col("date").cast("string"))
    return parts.unionByName(unmatched.withColumn("matched", F.lit(False)), allowMissingColumns=True)


@query(
    """SELECT DISTINCT strftime(o_orderdate, 'Transactions_%Y%m%d.csv') AS name FROM orders
       WHERE o_orderdate NOT IN (SELECT l_shipdate FROM lineitem)"""
)
def new_files_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offered names that were not taken over yet."""

    def names(name: str, ts: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.date_format(ts, "'Transactions_'yyyyMMdd'.csv'").alias("name")
        )

    offered = names("orders", "o_orderdate").distinct()
    return new_files(offered, names("lineitem", "l_shipdate"))


# Without Hadoop's native library, each local file, its checksum file and its folder start a process that
# sets a mode. Written to the plain local file system only the folder does; others do not follow this.
MANY_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}


@query(
    """SELECT page_id, 'sha256:' || sha256(html || chr(10)) AS found, page_id % 3 <> 1 AS ok
       FROM pages WHERE page_id % 5 <> 2
       UNION ALL
       SELECT page_id, NULL, FALSE FROM pages WHERE page_id % 5 = 2"""
)
def file_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed as a file each, checked against a manifest with sizes.

    Of some the manifest has another digest, of some another size, so that these are not read. Files
    above 4 KB are digested as streams, the others whole.
    """
    pages = table(spark, sf_dir, "pages")
    path = fresh_dir(spark, "pages")
    landed = pages.select("page_id", F.col("html").alias("value")).repartition("page_id")
    landed.write.options(**MANY_FILES).partitionBy("page_id").text(path)
    name = F.regexp_extract("path", "page_id=([0-9]+)/", 1).cast("long").alias("page_id")
    files = list_files(spark, path).select(name, "path", "file", "length")
    digest = F.sha2(F.concat("html", F.when(F.col("page_id") % 3 == 1, " ").otherwise("\n")), 256)
    size = F.octet_length("html") + F.when(F.col("page_id") % 5 == 2, 2).otherwise(1)
    stated = pages.select("page_id", F.concat(F.lit("sha256:"), digest).alias("checksum"), size.alias("bytes"))
    return verify_files(files, stated, "page_id", whole_bytes=4096).select("page_id", "found", "ok")


@query(
    """SELECT doc_id, 'sha256:' || sha256(replace(text, chr(10), ' ')) AS checksum,
              'sha256:' || sha256(text) AS found, NOT contains(text, chr(10)) AS ok
       FROM documents""",
    name="verify_checksums",
)
def verify_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts against a manifest that was made before line breaks got in."""
    documents = table(spark, sf_dir, "documents")
    files = documents.select("doc_id", F.encode("text", "UTF-8").alias("content"))
    stated = documents.select(
        "doc_id",
        F.concat(F.lit("sha256:"), F.sha2(F.replace("text", F.lit("\n"), F.lit(" ")), 256)).alias("checksum"),
    )
    return verify_checksums(files, stated, "doc_id")


@query(
    """SELECT event_id, event_type FROM events
       WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-17'""",
    name="extract_window",
)
def window_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extract window."""
    events = table(spark, sf_dir, "events")
    return extract_window(events, "ts", "2024-01-10", 7, ["event_id", "event_type"], allowed=["ts"])


@query("SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem", name="project_fields")
def named_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An explicit field list."""
    lineitem = table(spark, sf_dir, "lineitem")
    return project_fields(lineitem, ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"])


@query("SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-29'")
def lookback_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default window of a daily extract."""
    events = table(spark, sf_dir, "events")
    start = lookback(CLOCK, 3).cast("timestamp_ntz")
    return events.where(F.col("ts") >= start).select("event_id", "event_type")


@query("SELECT count(*) AS expected, count(*) AS found, TRUE AS ok FROM events")
def land_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, Q1, A1: rows landed against rows read back, the schema inferred."""
    zones = fresh_zones(spark, "roundtrip")
    landed = land_jsonl(table(spark, sf_dir, "events"), zones, "events", batch_id("events", CLOCK))
    return reconcile(landed, read_jsonl(spark, f"{zones.landing}/events/*"))


@query(
    """SELECT 'full' AS base, count(*) AS landed, TRUE AS waiting FROM events
       UNION ALL SELECT 'none', count(*), FALSE FROM events WHERE value < 0"""
)
def empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: a batch without rows does not show up in the manifest."""
    events, zones = table(spark, sf_dir, "events"), fresh_zones(spark, "empty")
    landed = [
        ("full", land_jsonl(events, zones, "events", "full")),
        ("none", land_jsonl(events.where("value < 0"), zones, "events", "none")),
    ]
    batches = manifest(spark, zones.landing).select("batch").distinct()
    counts = spark.createDataFrame(landed, "base string, landed long")
    name = F.concat("base", F.lit(".jsonl"))
    return counts.join(batches, name == F.col("batch"), "left").select(
        "base", "landed", F.col("batch").isNotNull().alias("waiting")
    )


@query("SELECT count(*) AS names, count(*) AS distinct_names, count(*) AS well_formed FROM events", name="batch_names")
def unique_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: batch names are unique and sort by time."""
    names = materialize(
        table(spark, sf_dir, "events").select(batch_names("events", F.col("ts")).alias("name")), "names"
    )
    form = F.col("name").rlike(r"^events_\d{8}T\d{6}_[0-9a-f]{32}$")
    return names.groupBy("name").agg(F.count("*").alias("n"), F.first(form).alias("form")).agg(
        F.sum("n").alias("names"),
        F.count("*").alias("distinct_names"),
        F.sum(F.when(F.col("form"), F.col("n"))).alias("well_formed"),
    )


@query(
    """SELECT event_id, strftime(ts, 'events_%Y%m%d.jsonl') AS batch,
              dense_rank() OVER (ORDER BY CAST(ts AS DATE)) - 1 AS micros
       FROM events"""
)
def per_file_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of all batches; each has its own insert time."""
    zones, feed = fresh_zones(spark, "stamps"), daily_feed(spark, sf_dir)
    land_batches(feed, zones, "events", "name")
    waiting = materialize(manifest(spark, zones.landing), "manifest")
    batches = waiting.select("batch", "folder").distinct().collect()
    rows = read_jsonl(spark, [b["folder"] for b in batches], "user_id BIGINT, _event_id BIGINT")
    start = int(CLOCK.timestamp()) * 1_000_000
    return stamp_batches(rows, [b["batch"] for b in batches], CLOCK).select(
        F.col("_event_id").alias("event_id"),
        batch_of(F.col(SOURCE)).alias("batch"),
        (F.unix_micros("_bronze_insert_ts") - start).alias("micros"),
    )


@query(
    """SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN '{"event_id":' || event_id END AS broken
       FROM events""",
    name="split_corrupt",
)
def corrupt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: lines that were cut off are kept apart, whole."""
    events = table(spark, sf_dir, "events")
    whole = F.to_json(F.struct("event_id", "event_type"))
    lines = events.select(
        F.when(F.col("event_type") == "error", F.substring_index(whole, ",", 1)).otherwise(whole).alias("value")
    )
    path = fresh_dir(spark, "cut")
    lines.write.text(path)
    scanned = materialize(read_jsonl(spark, path, "event_id BIGINT, event_type STRING"), "scanned")
    good, bad = split_corrupt(scanned)
    cut = bad.select(F.col("_corrupt_record").alias("broken")).withColumns(
        {
            "event_id": F.regexp_extract("broken", r"(\d+)$", 1).cast("long"),
            "event_type": F.lit("error"),
        }
    )
    return good.drop(SOURCE).unionByName(cut, allowMissingColumns=True)


@query(
    """SELECT c_custkey, CASE WHEN c_nationkey % 4 = 3 THEN c_nationkey END AS c_nationkey,
              CASE WHEN c_nationkey % 4 = 3 THEN 'x' END AS mark,
              CASE c_nationkey % 4 WHEN 0 THEN c_custkey || ',' || c_nationkey
                                   WHEN 1 THEN c_custkey || ',' || c_nationkey || ',x,y'
                                   WHEN 2 THEN c_custkey || ',none,x' END AS broken
       FROM customer""",
    name="split_corrupt_csv",
)
def corrupt_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: CSV lines that are cut, too long or of another type are kept apart, whole."""
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    kind = F.col("c_nationkey") % 4
    line = (
        F.when(kind == 0, F.concat_ws(",", key, nation))
        .when(kind == 1, F.concat_ws(",", key, nation, F.lit("x"), F.lit("y")))
        .when(kind == 2, F.concat_ws(",", key, F.lit("none"), F.lit("x")))
        .otherwise(F.concat_ws(",", key, nation, F.lit("x")))
    )
    path = fresh_dir(spark, "cut")
    lines = table(spark, sf_dir, "customer").select(line.alias("c_custkey,c_nationkey,mark"))
    lines.write.options(header=True, sep="\t", quote="").csv(path)
    scanned = materialize(read_csv(spark, path, "c_custkey BIGINT, c_nationkey INT"), "scanned")
    good, bad = split_corrupt(scanned)
    cut = bad.select(F.col(CORRUPT).alias("broken")).withColumn(
        "c_custkey", F.substring_index("broken", ",", 1).cast("long")
    )
    return good.drop(SOURCE).unionByName(cut, allowMissingColumns=True)
