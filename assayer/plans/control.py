"""Control tables: what is pending, what applies to it, suites, and the ledger's next snapshot.

All of it is joins and aggregates, so ledgers and configurations of any size stay distributed. No
side is hinted as broadcast: configuration and ledger may both be large, and Spark broadcasts the one
that turns out small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.metrics import parse_params

TABLE = ["schema_name", "table_name"]


def pending_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs that no run has finished."""
    return jobs.filter(F.col("job_status").isNull())


def active_checks(config: DataFrame, checks: DataFrame) -> DataFrame:
    """Active configuration rows with the name of their check."""
    return (
        config.filter(F.col("flag") == 1)
        .join(checks, "exp_id")
        .select(
            "config_id",
            "exp_id",
            "schema_name",
            "table_name",
            "column_name",
            "expectation_parameters",
            "expectation_name",
        )
    )


def job_plan(active: DataFrame, pending: DataFrame) -> DataFrame:
    """Every active check of a table with every pending job on that table.

    Checks without a column stay: they are about the table. Those without a name cannot be run.
    """
    named = active.filter(F.col("expectation_name").isNotNull())
    return named.join(pending, TABLE)


def column_checks(plan: DataFrame) -> DataFrame:
    """The part of a plan that is about columns."""
    return plan.filter(F.col("column_name").isNotNull() & F.col("expectation_name").isNotNull())


def distinct_jobs(plan: DataFrame) -> DataFrame:
    return plan.select("job_id", "job_name", *TABLE).distinct()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per `keys`, the least by `order`: aggregated, so that no key's rows gather in a task.

    Among rows equal in `order` the least by the whole row is kept.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    least = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("least"))
    return least.select(
        *[
            F.col(c) if c in keys else F.col("least").getField(c).alias(c)
            for c in df.columns
        ]
    )


def with_params(config: DataFrame) -> DataFrame:
    """Configuration with its parameters as a struct `params`."""
    return config.withColumn("params", parse_params(F.col("expectation_parameters")))


def build_suites(catalogue: DataFrame) -> DataFrame:
    """The suites of a catalogue that names suites itself: one row per check of a suite, with the
    number of catalogue rows it stands for. A suite of any size is rows, never one list."""
    return catalogue.groupBy(
        "expectation_suite_name",
        "expectation_name",
        F.col("expectation_code").alias("expectation_parameters"),
        "schema_name",
        "table_name",
    ).agg(F.count(F.lit(1)).alias("entries"))


def ledger_transition(jobs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The ledger after a run: pending jobs with an outcome take it over, all other rows stay.

    `outcomes` has one row per job: job_id, run_id, job_status, status_msg, execution_start_time,
    execution_end_time. Spark cannot overwrite what it reads, so the result is the next snapshot,
    written to a path of its own; a ledger has one writer at a time.
    """
    taken = [
        "run_id",
        "job_status",
        "status_msg",
        "execution_start_time",
        "execution_end_time",
    ]
    new = outcomes.select(
        F.col("job_id").alias("__job_id"), *[F.col(c).alias(f"__{c}") for c in taken]
    )
    moves = F.col("job_status").isNull() & F.col("__job_id").isNotNull()

    def value(name: str) -> Column:
        if name not in taken:
            return F.col(name)
        if name == "status_msg":  # a message that is already there is kept
            changed = F.coalesce(F.col(name), F.col("__status_msg"))
        else:
            changed = F.col(f"__{name}")
        return F.when(moves, changed).otherwise(F.col(name)).alias(name)

    return jobs.join(new, F.col("job_id") == F.col("__job_id"), "left").select(
        *[value(c) for c in jobs.columns]
    )
