"""Metrics and details: long and wide forms, suite statistics, failed checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.metrics import (
    metric_check,
    metric_column,
    metric_key,
    metric_value,
    passed_message,
)
from assayer.model import CHECK_METRICS, DISTINCT_IN_SET
from assayer.operators.scorecard import DISTINCT_SUMMARY_SQL

# What the details of a check that cannot be run begin with.
INVALID = "invalid check: "

CHECK_KEYS = ["run_id", "job_id", "config_id", "expectation_name", "column_name"]


def metrics_long(details: DataFrame, observed: DataFrame | None = None) -> DataFrame:
    """Details as one row per metric; a metric without a value has no row. No shuffle.

    A distinct-values check has an `observed_value` per value it saw: these come from `observed` (CHECK_KEYS and
    `value`), not from its details.
    """
    values = {
        "element_count": F.col("scanned").cast("string"),
        "unexpected_count": F.col("failure").cast("string"),
        "observed_value": F.when(
            (F.col("expectation_name") != DISTINCT_IN_SET) | F.col("scanned").isNull(), F.col("details")
        ),
        "success": F.col("expectation_status").cast("string"),
    }
    rows = [
        F.when(
            values[m].isNotNull(), F.struct(F.lit(m).alias("metric"), values[m].alias("value"))
        )
        for m in CHECK_METRICS
    ]
    long = details.select(*CHECK_KEYS, F.inline(F.array_compact(F.array(*rows))))
    if observed is None:
        return long
    return long.unionByName(
        observed.select(*CHECK_KEYS, F.lit("observed_value").alias("metric"), "value")
    )


def suite_metrics_long(statistics: DataFrame) -> DataFrame:
    """Suite statistics as one row per metric."""
    names = [
        "evaluated_expectations",
        "successful_expectations",
        "unsuccessful_expectations",
        "success_percent",
    ]
    # The percentage as a decimal of fixed scale: a double has no one spelling.
    kinds = {"success_percent": "decimal(9,4)"}
    rows = [
        F.struct(
            F.lit(n).alias("metric"), F.col(n).cast(kinds.get(n, "bigint")).cast("string").alias("value")
        )
        for n in names
    ]
    return statistics.select("run_id", "job_id", F.inline(F.array(*rows))).filter(
        F.col("value").isNotNull()
    )


def metrics_for_run(metrics: DataFrame, run_id: str, column: str = "run_id") -> DataFrame:
    return metrics.filter(F.col(column) == F.lit(run_id))


def details_wide(metrics: DataFrame) -> DataFrame:
    """Long metrics as one row per check.

    Status and counts are fixed-width, so they are gathered by one hash aggregate. Only the observed texts, which would
    make it sort every row, are gathered apart and joined; those of distinct-values checks, a row per value,
    stay out of it, as the check's details follow from its counts.
    """

    def value(metric: str, kind: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("value").cast(kind)))

    wide = metrics.groupBy(*CHECK_KEYS).agg(
        value("success", "boolean").alias("expectation_status"),
        value("element_count", "bigint").alias("scanned"),
        value("unexpected_count", "bigint").alias("failure"),
    )
    counted = (F.col("expectation_name") == DISTINCT_IN_SET) & F.col("scanned").isNotNull()
    no_value = (F.col("expectation_name") != DISTINCT_IN_SET) | F.startswith("value", F.lit(INVALID))
    texts = metrics.filter((F.col("metric") == "observed_value") & no_value)
    texts = texts.groupBy(*CHECK_KEYS).agg(F.max("value").alias("observed"))
    same = F.lit(True)
    for c in CHECK_KEYS:
        same &= F.col(f"w.{c}").eqNullSafe(F.col(f"t.{c}"))
    joined = wide.alias("w").join(texts.alias("t"), same, "left").select("w.*", "t.observed")
    return joined.select(
        *CHECK_KEYS,
        "expectation_status",
        "scanned",
        (F.col("scanned") - F.col("failure")).alias("success"),
        "failure",
        F.when(counted, F.expr(DISTINCT_SUMMARY_SQL)).otherwise(F.col("observed")).alias("details"),
    )


def parse_metrics(packed: DataFrame) -> DataFrame:
    """Packed metric rows with their parts: check, column, key and value."""
    return packed.select(
        F.col("run_name").alias("run_id"),
        F.col("expectation_suite_identifier").alias("suite"),
        metric_check(F.col("metric_name")).alias("expectation_name"),
        metric_column(F.col("metric_kwargs_id")).alias("column_name"),
        metric_key(F.col("metric_name")).alias("metric"),
        metric_value(F.col("value")).alias("value"),
    )


def join_metrics(plan: DataFrame, packed: DataFrame, run_id: str | None = None) -> DataFrame:
    """Planned checks with their packed metrics, by run, check and column; of one run, or of all.

    Packed names carry no config id: two configurations of one check on one column get the same
    metrics.
    """
    keys = ["run_id", "expectation_name", "column_name"]
    if run_id is not None:
        plan = plan.filter(F.col("run_id") == F.lit(run_id))
        packed = packed.filter(F.col("run_name") == F.lit(run_id))
    packed = packed.filter(F.col("metric_kwargs_id").contains("="))  # those of suites have no column
    planned = plan.select(*keys, "job_id", "config_id", "schema_name", "table_name")
    # What is not a key is parsed after the join, for the rows that are left.
    keyed = packed.select(
        F.col("run_name").alias("run_id"),
        metric_check(F.col("metric_name")).alias("expectation_name"),
        metric_column(F.col("metric_kwargs_id")).alias("column_name"),
        "metric_name",
        "value",
    )
    return planned.join(keyed, keys).select(
        *planned.columns,
        metric_key(F.col("metric_name")).alias("metric"),
        metric_value(F.col("value")).alias("value"),
    )


def suite_statistics(details: DataFrame) -> DataFrame:
    """Evaluated, successful and unsuccessful checks per run and job. A check without a status (its
    name is unknown, or it could not be run) is not counted as evaluated."""
    evaluated = F.count("expectation_status")
    successful = F.count_if(F.col("expectation_status"))
    counted = details.groupBy("run_id", "job_id").agg(
        evaluated.alias("evaluated_expectations"),
        successful.alias("successful_expectations"),
    )
    ok, n = F.col("successful_expectations"), F.col("evaluated_expectations")
    return counted.select(
        "run_id",
        "job_id",
        "evaluated_expectations",
        "successful_expectations",
        (n - ok).alias("unsuccessful_expectations"),
        F.when(n > 0, F.lit(100.0) * ok / n).alias("success_percent"),
        passed_message(ok, n).alias("status_msg"),
    )


def packed_statistics(packed: DataFrame, jobs: DataFrame) -> DataFrame:
    """Suite messages from packed metrics: those of a run and suite with the job they belong to."""
    parsed = parse_metrics(packed).filter(F.col("expectation_name") == "statistics")

    def value(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("value"))).cast("bigint")

    counted = parsed.groupBy("run_id", "suite").agg(
        value("successful_expectations").alias("successful_expectations"),
        value("evaluated_expectations").alias("evaluated_expectations"),
    )
    open_jobs = jobs.filter(F.col("status_msg").isNull()).select("job_id", "job_name", "run_id")
    joined = counted.join(
        open_jobs,
        (counted["run_id"] == open_jobs["run_id"]) & (counted["suite"] == open_jobs["job_name"]),
    )
    return joined.select(
        counted["run_id"],
        "job_id",
        "job_name",
        "evaluated_expectations",
        "successful_expectations",
        passed_message(
            F.col("successful_expectations"), F.col("evaluated_expectations")
        ).alias("status_msg"),
    )


def failed_checks(
    details: DataFrame, config: DataFrame, checks: DataFrame, jobs: DataFrame, run_id: str | None = None
) -> DataFrame:
    """Failed checks with all that is needed to fetch their rows (of one run, or of all)."""
    if run_id is not None:
        jobs = jobs.filter(F.col("run_id") == F.lit(run_id))
    failed = details.filter(~F.col("expectation_status")).select(
        "job_id", "config_id", "expectation_status"
    )
    # Configuration and catalogue first: what they make is small beside the details.
    return (
        failed.join(config.join(checks, "exp_id"), "config_id")
        .join(jobs.drop("schema_name", "table_name"), "job_id")
        .select(
            "job_id",
            "config_id",
            "expectation_status",
            "exp_id",
            "schema_name",
            "table_name",
            "column_name",
            "expectation_parameters",
            "expectation_name",
            "job_name",
            "run_id",
            "pipeline_run_id_name",
            "pipeline_run_id",
        )
    )
