"""Run states: newest run per job and the release gate (A3, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.functions.columns import column

# Run states as (life cycle, result).
RUNNING = [("RUNNING", None)]
SUCCESS = [("TERMINATED", "SUCCESS")]
FAILED = [
    ("NEVER_RUN", None),
    ("INTERNAL_ERROR", "FAILED"),
    ("TERMINATED", "FAILED"),
    ("SKIPPED", None),
]


def latest_run(
    jobs: DataFrame, runs: DataFrame, job: str, run_job: str, ts: str, run_id: str
) -> DataFrame:
    """Every job with the state of its newest run, or ``NEVER_RUN`` (A3).

    ``runs`` has ``life_cycle_state`` and ``result_state``. Runs of one time are ordered
    by their id.
    """
    newest = runs.groupBy(column(run_job).alias("__job")).agg(
        F.max_by(
            F.struct("life_cycle_state", "result_state"), F.struct(column(ts), column(run_id))
        ).alias("__state")
    )
    joined = jobs.join(newest, column(job) == F.col("__job"), "left")
    never = F.col("__job").isNull()
    return joined.select(
        *[column(c) for c in jobs.columns],
        F.when(never, "NEVER_RUN").otherwise(F.col("__state.life_cycle_state")).alias("life_cycle_state"),
        F.when(~never, F.col("__state.result_state")).alias("result_state"),
    )


def _is_one_of(states: list[tuple[str, str | None]]):
    found = F.lit(False)
    for life_cycle, result in states:
        found = found | (
            F.col("life_cycle_state").eqNullSafe(F.lit(life_cycle))
            & F.col("result_state").eqNullSafe(F.lit(result).cast("string"))
        )
    return found


def run_gate(latest: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One ``gate`` per group, or for all jobs (A4).

    An unknown state gives ``error_unknown``; else a failed one ``error_failed``; else a
    running one ``wait``; else, also without any job, ``release``.
    """
    known = _is_one_of(FAILED) | _is_one_of(SUCCESS) | _is_one_of(RUNNING)
    gate = (
        F.when(F.coalesce(F.bool_or(~known), F.lit(False)), "error_unknown")
        .when(F.coalesce(F.bool_or(_is_one_of(FAILED)), F.lit(False)), "error_failed")
        .when(F.coalesce(F.bool_or(_is_one_of(RUNNING)), F.lit(False)), "wait")
        .otherwise("release")
    )
    return latest.groupBy(*(by or [])).agg(gate.alias("gate"), F.count("*").alias("jobs"))
