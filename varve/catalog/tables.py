"""Stored tables, table diffs and run states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.catalog.base import fresh_zones, query, table
from varve.functions.hashing import record_hash
from varve.operators.diff import duplicates, table_diff
from varve.operators.runs import latest_run, run_gate
from varve.sources.store import Store


def order_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


ORDERS_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders
"""


@query(ORDERS_SQL)
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table."""
    store = Store(spark, fresh_zones(spark, "scan"))
    store.replace(table(spark, sf_dir, "orders"), "orders")
    return order_rows(store.read("orders"))


@query(
    f"""SELECT *, CASE o_orderstatus WHEN 'F' THEN 'filled' END AS note FROM ({ORDERS_SQL})
        WHERE o_orderstatus <> 'P'"""
)
def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, K3: a table replaced by what is read from it, with a new column."""
    store = Store(spark, fresh_zones(spark, "replace"))
    store.replace(table(spark, sf_dir, "orders"), "orders")
    note = F.when(F.col("o_orderstatus") == "F", "filled")
    store.replace(store.read("orders").where("o_orderstatus <> 'P'").withColumn("note", note), "orders")
    return order_rows(store.read("orders"))


@query(
    f"""SELECT * REPLACE (CASE WHEN o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2001-07-01')
                               THEN 'seen' ELSE o_orderstatus END AS o_orderstatus)
        FROM ({ORDERS_SQL})"""
)
def replace_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: only the buckets that changed keys fall in are written again."""
    orders = table(spark, sf_dir, "orders")
    store = Store(spark, fresh_zones(spark, "buckets"), buckets=16)
    store.replace(orders, "orders", key=["o_custkey"])
    changed = orders.where("o_orderdate >= DATE'2001-07-01'").select("o_custkey").distinct()
    buckets = store.touched("orders", changed)
    part = store.read_or_none("orders", buckets)
    marked = part.join(changed.withColumn("hit", F.lit(True)), "o_custkey", "left").withColumn(
        "o_orderstatus", F.when(F.col("hit"), "seen").otherwise(F.col("o_orderstatus"))
    )
    store.replace_buckets(marked.drop("hit"), "orders", buckets)
    return order_rows(store.read("orders"))


# The state of each customer's orders of one priority, at two times.
VERSION = """
    SELECT o_custkey || ':' || o_orderpriority AS name, max(o_orderstatus) AS status, min(o_orderkey) AS id,
           '{{"name":"' || o_custkey || ':' || o_orderpriority || '","status":"' || max(o_orderstatus) || '"}}' AS record
    FROM orders WHERE o_orderdate {when} DATE '1998-04-01' GROUP BY o_custkey, o_orderpriority
"""


@query(
    f"""SELECT coalesce(n.name, o.name) AS name,
               CASE WHEN o.name IS NULL THEN 'add' WHEN n.name IS NULL THEN 'remove'
                    WHEN n.status = o.status THEN 'unchanged' ELSE 'update' END AS change,
               sha256(n.record) AS new_hash, sha256(o.record) AS old_hash, o.id
        FROM ({VERSION.format(when='>=')}) n FULL JOIN ({VERSION.format(when='<')}) o ON n.name = o.name""",
    name="table_diff",
)
def orders_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two states of a keyed table."""
    orders = table(spark, sf_dir, "orders")
    name = F.concat_ws(":", "o_custkey", "o_orderpriority")

    def version(rows: DataFrame) -> DataFrame:
        state = rows.groupBy(name.alias("name")).agg(
            F.max("o_orderstatus").alias("status"), F.min("o_orderkey").alias("id")
        )
        return state.withColumn("hash", record_hash(state, ["name", "status"]))

    before = F.col("o_orderdate") < "1998-04-01"
    return table_diff(version(orders.where(~before)), version(orders.where(before)), "name", "hash", "id")


@query(
    "SELECT lower(p_name) AS name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1",
    name="duplicate_names",
)
def part_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: names that occur more than once, whatever their case."""
    named = F.when(F.col("p_size") < 25, F.upper("p_name")).otherwise(F.col("p_name"))
    return duplicates(table(spark, sf_dir, "part").withColumn("p_name", named), "p_name")


RUNS = """
    SELECT o_orderkey, o_custkey, o_orderdate,
           CASE WHEN o_totalprice > 400000 THEN 'PENDING' WHEN o_orderstatus = 'O' THEN 'RUNNING' ELSE 'TERMINATED' END AS life_cycle_state,
           CASE WHEN o_totalprice > 400000 OR o_orderstatus = 'O' THEN NULL
                WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS result_state
    FROM orders
"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs of their customer's job."""
    unknown, running = F.col("o_totalprice") > 400000, F.col("o_orderstatus") == "O"
    life_cycle = F.when(unknown, "PENDING").when(running, "RUNNING").otherwise("TERMINATED")
    result = F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        "o_orderpriority",
        life_cycle.alias("life_cycle_state"),
        F.when(~unknown & ~running, result).alias("result_state"),
    )


@query(
    f"""SELECT c_custkey, coalesce(life_cycle_state, 'NEVER_RUN') AS life_cycle_state, result_state
        FROM (SELECT c_custkey FROM customer UNION ALL SELECT -c_custkey FROM customer) LEFT JOIN (
          SELECT * FROM ({RUNS})
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
        ) ON c_custkey = o_custkey""",
    name="latest_run",
)
def newest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the newest run of every job, or that it never ran, as those with a negative key."""
    jobs = table(spark, sf_dir, "customer").select("c_custkey")
    jobs = jobs.union(jobs.select(-F.col("c_custkey")))
    return latest_run(jobs, runs(spark, sf_dir), "c_custkey", "o_custkey", "o_orderdate", "o_orderkey")


@query(
    f"""SELECT o_custkey, count(*) AS jobs, CASE
               WHEN bool_or(life_cycle_state = 'PENDING') THEN 'error_unknown'
               WHEN bool_or(coalesce(result_state = 'FAILED', FALSE)) THEN 'error_failed'
               WHEN bool_or(life_cycle_state = 'RUNNING') THEN 'wait' ELSE 'release' END AS gate
        FROM ({RUNS}) GROUP BY o_custkey""",
    name="run_gate",
)
def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: whether the runs allow a release."""
    return run_gate(runs(spark, sf_dir), ["o_custkey"])
