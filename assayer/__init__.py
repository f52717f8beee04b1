"""Metadata-driven data validation on Spark DataFrames."""

from assayer.model import Check, CheckError, Control
from assayer.operators.registry import register_query_check, register_row_check
from assayer.operators.scorecard import scorecard
from assayer.operators.failed import failed_rows
from assayer.plans.runner import Results, run_jobs

__all__ = [
    "Check",
    "CheckError",
    "Control",
    "Results",
    "failed_rows",
    "register_query_check",
    "register_row_check",
    "run_jobs",
    "scorecard",
]
