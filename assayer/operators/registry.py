"""Check names and how each compiles.

A row-level check compiles to a boolean violation Column, so that any number of them is evaluated in
one scan. The other kinds (unique keys, distinct values, duplicate groups, queries) each need an
aggregation of their own and are found in their modules.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions import predicates as P
from assayer.functions.columns import column, column_type, free_names, typed_literal, typed_texts
from assayer.model import (
    CONTAINS,
    CONTAINS_PRAF,
    DISTINCT_IN_SET,
    IN_SET,
    LENGTH,
    LIKE,
    NOT_NULL,
    QUERIED_UNIQUE,
    UNIQUE,
    Check,
    CheckError,
)
from assayer.sources.local import local_frame

# A value set up to this size becomes an IN list; a larger one is joined.
INLINE_VALUES = 1_000
# A joined value set is broadcast up to this size; beyond it Spark chooses the join.
BROADCAST_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class Lookup:
    """A value set too long for an IN list: `values` has the columns `key` and `marker`. `small` if it is broadcast."""

    values: DataFrame
    key: str
    marker: str
    on: str
    small: bool


@dataclass(frozen=True)
class Violation:
    """A compiled row-level check."""

    check: Check
    broken: Column
    judges_nulls: bool = False  # whether rows with NULL count for the tolerance
    lookup: Lookup | None = None


#: In the SQL of a query check the run column, or for a whole table a column with one value.
GROUP = "{group}"


@dataclass(frozen=True)
class QueryCheck:
    """SQL over `{active_batch}` whose first cell is judged by `success(observed, params)`. With `{group}` in it, it gives
    a row for each group: the group, and the cell that is judged."""

    sql: str
    success: Callable[[Column, Mapping[str, Any]], Column]


_row_checks: dict[str, Callable[[DataFrame, Check], Violation]] = {}
_query_checks: dict[str, QueryCheck] = {}


def register_row_check(
    name: str, violation: Callable[[Column, Mapping[str, Any]], Column]
) -> None:
    """Add a row-level check: `violation(column, params)` is true for a violating row."""

    def compiled(batch: DataFrame, check: Check) -> Violation:
        column_type(batch, check.column)
        col = column(check.column)
        return Violation(check, violation(col, check.params))

    _row_checks[name] = compiled


def register_query_check(
    name: str, sql: str, success: Callable[[Column, Mapping[str, Any]], Column]
) -> None:
    """Add a query check: `sql` reads `{active_batch}`, `success(observed, params)` judges."""
    _query_checks[name] = QueryCheck(sql, success)


def kind(check: Check) -> str | None:
    """Which evaluation a check takes; None for an unknown name."""
    if check.name in _row_checks:
        return "row"
    if check.name in _query_checks:
        return "query"
    if check.name == UNIQUE:
        return "unique"
    if check.name == DISTINCT_IN_SET:
        return "distinct"
    if check.name == QUERIED_UNIQUE:
        return "query" if check.params.get("query") is not None else "groups"
    return None


def query_check(check: Check) -> QueryCheck:
    if check.name in _query_checks:
        return _query_checks[check.name]
    value = expected_value(check)
    sql = check.params["query"]
    if not isinstance(sql, str):
        raise CheckError("query must be text")
    # A cell that is no number is not the value; under ANSI a plain comparison would end the run.
    return QueryCheck(sql, lambda observed, _: observed.try_cast("decimal(38,6)") == F.lit(value))


def violation(batch: DataFrame, check: Check) -> Violation:
    """Compile a row-level check, or the row-level side of a distinct-values check."""
    if check.name == DISTINCT_IN_SET:
        return _outside_set(batch, check)
    return _row_checks[check.name](batch, check)


def has_row_violations(check: Check) -> bool:
    return kind(check) in ("row", "distinct")


def with_lookups(batch: DataFrame, violations: list[Violation]) -> DataFrame:
    """`batch` with a marker column for each long value set; row count and order of columns stay."""
    for v in violations:
        if v.lookup is not None:
            batch = batch.join(
                v.lookup.values, column(v.lookup.on) == F.col(v.lookup.key), "left"
            ).drop(v.lookup.key)
    return batch


def expected_value(check: Check) -> int:
    value = check.params.get("value")
    if value is None:
        raise CheckError("value must be given")
    if isinstance(value, bool) or not isinstance(value, int) or value < 0:
        raise CheckError("value must be an integer from 0 up")
    return value


def repeated_row_options(batch: DataFrame, check: Check) -> tuple[str | None, list[str] | None]:
    """Which repeated rows a uniqueness check gives, and the columns that tell them apart."""
    mode, tie = check.params.get("failed_rows"), check.params.get("tie_columns")
    if mode not in (None, "all", "extra"):
        raise CheckError("failed_rows must be 'all' or 'extra'")
    if tie is not None and (not isinstance(tie, list) or not tie):
        raise CheckError("tie_columns must be a list of column names")
    for name in tie or []:
        column_type(batch, name)
    return mode, tie


def _text_param(check: Check, key: str) -> str:
    value = check.params.get(key)
    if not isinstance(value, str):
        raise CheckError(f"{key} must be text")
    return value


def _row(name: str, **fixed: Any):
    """Register a built-in: the decorated function maps (column, check) to a violation Column."""

    def add(build: Callable[[Column, Check], Column]):
        def compiled(batch: DataFrame, check: Check) -> Violation:
            column_type(batch, check.column)
            check = Check(
                check.config_id, check.name, check.column, {**fixed, **check.params}, check.parameters
            )
            return Violation(check, build(column(check.column), check), name == NOT_NULL)

        _row_checks[name] = compiled
        return build

    return add


@_row(NOT_NULL)
def _not_null(col: Column, check: Check) -> Column:
    return P.is_missing(col)


@_row(LENGTH)
def _length(col: Column, check: Check) -> Column:
    return P.length_differs(col, expected_value(check), bool(check.params.get("rtrim", False)))


@_row(LIKE)
def _like(col: Column, check: Check) -> Column:
    ignore_case = bool(check.params.get("ignore_case", False))
    pattern, escape = _text_param(check, "like_pattern"), check.params.get("escape")
    if escape is not None:
        if not isinstance(escape, str) or len(escape) != 1 or escape in "%_":
            raise CheckError("escape must be one character other than % and _")
        rest = re.sub(f"{re.escape(escape)}[%_{re.escape(escape)}]", "", pattern)
        if escape in rest:
            raise CheckError(f"in {pattern!r} the escape is not followed by %, _ or itself")
    return P.unlike(col, pattern, ignore_case, escape)


@_row(CONTAINS)
@_row(CONTAINS_PRAF, substring="praf")
def _contains(col: Column, check: Check) -> Column:
    return P.lacks_substring(col, _text_param(check, "substring"))


def _outside_set(batch: DataFrame, check: Check) -> Violation:
    dtype = column_type(batch, check.column)
    values = check.params.get("value_set")
    if not isinstance(values, list):
        raise CheckError("value_set must be a list")
    texts = typed_texts(batch.sparkSession, values, dtype)
    col = column(check.column)
    if len(texts) <= INLINE_VALUES:
        literals = [typed_literal(t, dtype) for t in texts]
        return Violation(check, P.outside_set(col, literals))
    lookup = _lookup(batch, check, texts, dtype)
    return Violation(check, col.isNotNull() & F.col(lookup.marker).isNull(), lookup=lookup)


_row_checks[IN_SET] = _outside_set


def _lookup(batch: DataFrame, check: Check, texts: list[str], dtype: T.DataType) -> Lookup:
    key, marker = free_names(batch.columns, [f"__set_{check.config_id}", f"__in_set_{check.config_id}"])
    values = local_frame(batch.sparkSession, [(t,) for t in texts], "v string").select(
        F.col("v").cast(dtype).alias(key), F.lit(True).alias(marker)
    )
    small = sum(map(len, texts)) * 4 + 32 * len(texts) <= BROADCAST_BYTES
    if small:
        values = F.broadcast(values)
    return Lookup(values, key, marker, check.column, small)
