"""Violating rows of a batch, each tagged with the check that caught it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.columns import column, column_type, free_names
from assayer.model import TAG_COLUMNS, Check
from assayer.operators import registry
from assayer.operators.keys import repeated_rows

def tag_names(source: Sequence[str]) -> list[str]:
    """Names of the tag columns among those of the source."""
    return free_names(source, TAG_COLUMNS)


def config_name(source: Sequence[str]) -> str:
    """Name of the column that says which check a row broke, until the tags are all that is left."""
    return free_names([*source, *tag_names(source)], ["__config_id"])[0]


def failed_schema(source: T.StructType) -> T.StructType:
    """Schema of the violating rows: the source's columns and three nullable texts."""
    names = tag_names([f.name for f in source.fields])
    return T.StructType(list(source.fields) + [T.StructField(n, T.StringType()) for n in names])


def failed_rows(
    batch: DataFrame,
    checks: Sequence[Check],
    run_id: str,
    by: str | None = None,
    unique_mode: str = "extra",
) -> DataFrame:
    """Violating rows with `expectation_name, parameters, run_id`; a row that breaks two checks
    comes twice. Checks that have no violating rows (groups, queries, unknown names) add none."""
    rows = tagged_rows(batch, checks, by, unique_mode)
    names = tag_names(batch.columns)
    return rows.drop(config_name(batch.columns)).withColumn(names[2], F.lit(run_id).cast("string"))


def tagged_rows(
    batch: DataFrame,
    checks: Sequence[Check],
    by: str | None,
    unique_mode: str,
    failures: Mapping[int, int] | None = None,
) -> DataFrame:
    """Violating rows with the check's config id (under `config_name`), name and parameters. `failures` tells how many there
    are per config id, where the checks have been scored."""
    names = [config_name(batch.columns), *tag_names(batch.columns)[:2]]
    parts = []
    row_level = [c for c in checks if registry.has_row_violations(c)]
    if row_level:
        parts.append(_row_level(batch, row_level, names))
    for check in checks:
        if registry.kind(check) == "unique":
            column_type(batch, check.column)
            mode, tie = registry.repeated_row_options(batch, check)
            rows = batch.filter(check.row_condition) if check.row_condition else batch
            keys = [*([by] if by else []), check.column]
            known = (failures or {}).get(check.config_id)
            repeated = repeated_rows(
                rows,
                keys,
                mode or unique_mode,
                tie,
                keys_at_most=None if known is None else known // 2,
            )
            parts.append(
                repeated.select("*", *[c.alias(n) for c, n in zip(_tags(check), names)])
            )
    if not parts:
        text = F.lit(None).cast("string")
        return batch.filter(F.lit(False)).select(
            "*",
            F.lit(None).cast("bigint").alias(names[0]),
            text.alias(names[1]),
            text.alias(names[2]),
        )
    return reduce(DataFrame.unionByName, parts)


def _tags(check: Check) -> list[Column]:
    return [F.lit(check.config_id).cast("bigint"), F.lit(check.name), F.lit(check.parameters)]


def _row_level(batch: DataFrame, checks: Sequence[Check], names: Sequence[str]) -> DataFrame:
    """One scan whatever the number of checks: a row is repeated once per check it breaks."""
    violations = [registry.violation(batch, c) for c in checks]
    broken = [
        v.broken & F.expr(v.check.row_condition) if v.check.row_condition else v.broken
        for v in violations
    ]
    marks = [
        F.when(b, F.struct(*[c.alias(n) for c, n in zip(_tags(v.check), names)]))
        for b, v in zip(broken, violations)
    ]
    return (
        registry.with_lookups(batch, violations)
        .filter(reduce(Column.__or__, broken))
        .select(
            *map(column, batch.columns), F.inline(F.array_compact(F.array(*marks)))
        )
    )
