"""Control-table schemas, check names and the `Check` record."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

# The check names that control tables hold.
DISTINCT_IN_SET = "expect_column_distinct_values_to_be_in_set"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
NOT_NULL = "expect_column_values_to_not_be_null"
LENGTH = "expect_column_value_lengths_to_equal"
LIKE = "expect_column_values_to_match_like_pattern"
CONTAINS = "expect_column_values_to_contain"
CONTAINS_PRAF = "expect_column_values_to_contain_praf"  # CONTAINS with substring "praf"
QUERIED_UNIQUE = "expect_queried_columns_to_be_unique"

# The keys under which metrics are reported.
CHECK_METRICS = ("element_count", "unexpected_count", "observed_value", "success")
SUITE_METRICS = (
    "evaluated_expectations",
    "successful_expectations",
    "unsuccessful_expectations",
    "success_percent",
)

CHECKS_SCHEMA = "exp_id bigint, expectation_name string"
CONFIG_SCHEMA = (
    "config_id bigint, exp_id bigint, schema_name string, table_name string, "
    "column_name string, expectation_parameters string, flag int"
)
JOBS_SCHEMA = (
    "job_id bigint, job_name string, schema_name string, table_name string, full_table int, "
    "pipeline_run_id_name string, pipeline_run_id string, run_id string, job_status string, "
    "status_msg string, execution_start_time timestamp, execution_end_time timestamp"
)
PARAMS_SCHEMA = (
    "value_set array<string>, value bigint, like_pattern string, substring string, "
    "columns array<string>, query string, mostly double, row_condition string"
)

# What one (batch, check) pair reports; `slice` is the run-column value, NULL for a full table.
SCORE_COLUMNS = (
    "config_id",
    "expectation_status",
    "scanned",
    "success",
    "failure",
    "details",
)

# Columns a violating row carries beside its own.
TAG_COLUMNS = ("expectation_name", "parameters", "run_id")


class CheckError(ValueError):
    """A check or job whose configuration cannot be run."""


@dataclass(frozen=True)
class Check:
    """One configured check: a registered name, a column (or none) and its parameters."""

    config_id: int
    name: str
    column: str | None = None
    params: Mapping[str, Any] = field(default_factory=dict)
    text: str | None = None  # the parameters as the control table spells them

    @classmethod
    def from_row(cls, row) -> "Check":
        text = row["expectation_parameters"]
        try:
            params = json.loads(text) if text and text.strip() else {}
        except json.JSONDecodeError as error:
            raise CheckError(f"parameters are not JSON: {error}") from error
        if not isinstance(params, dict):
            raise CheckError("parameters are not a JSON object")
        return cls(row["config_id"], row["expectation_name"], row["column_name"], params, text)

    @property
    def parameters(self) -> str:
        return self.text if self.text is not None else json.dumps(dict(self.params))

    @property
    def mostly(self) -> float:
        value = self.params.get("mostly")
        if value is None:
            return 1.0
        if isinstance(value, bool) or not isinstance(value, (int, float)) or not 0 <= value <= 1:
            raise CheckError("mostly must be a number from 0 to 1")
        return float(value)

    @property
    def row_condition(self) -> str | None:
        value = self.params.get("row_condition")
        if value is not None and not isinstance(value, str):
            raise CheckError("row_condition must be SQL text")
        return value


@dataclass(frozen=True)
class Control:
    """The three control tables."""

    checks: DataFrame
    config: DataFrame
    jobs: DataFrame
