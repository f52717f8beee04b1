"""Parsing of packed metric rows and JSON texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.model import PARAMS_SCHEMA


def parse_params(text: Column) -> Column:
    """Check parameters as a struct; keys that are absent are NULL fields."""
    return F.from_json(text, PARAMS_SCHEMA)


def metric_check(metric_name: Column) -> Column:
    """`<check>.result.<key>` -> `<check>`."""
    return F.substring_index(metric_name, ".", 1)


def metric_key(metric_name: Column) -> Column:
    """`<check>.result.<key>`, `<check>.success`, `statistics.<key>` -> `<key>`."""
    return F.substring_index(metric_name, ".", -1)


def metric_column(kwargs_id: Column) -> Column:
    """`column=<name>` -> `<name>`; NULL where there is no `=`, as suite statistics have."""
    after = F.substring_index(F.substring_index(kwargs_id, "=", 2), "=", -1)
    return F.when(F.contains(kwargs_id, F.lit("=")), after)


def metric_value(value: Column) -> Column:
    """`{"value": x}` -> x as text, NULL for JSON null."""
    return F.get_json_object(value, "$.value")


def passed_message(successful: Column, evaluated: Column) -> Column:
    return F.concat(
        successful.cast("string"), F.lit("/"), evaluated.cast("string"), F.lit(" Validations Passed")
    )
