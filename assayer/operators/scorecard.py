"""Scores of checks on a batch: scanned, success, failure, status and details per check.

A batch is a table, or the run slices of one; with `by` (the run column) every slice gets its own
scores. All row-level checks of a batch share one scan and one aggregation. Each other check is an
aggregation of its own over just its columns, since several distinct aggregates in one would multiply
every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.columns import column, column_type, free_names, group_key, quoted
from assayer.model import SCORE_COLUMNS, Check, CheckError
from assayer.operators import registry
from assayer.sources.local import local_frame

UNKNOWN = "unknown check"

# The share of good rows reaches `mostly`; nothing to check is a success.
WITHIN_TOLERANCE = "present = 0 OR CAST(present - failure AS double) / present >= mostly"

SCORE_SCHEMA = (
    "config_id bigint, expectation_status boolean, scanned bigint, success bigint, "
    "failure bigint, details string"
)


def scorecard(
    batch: DataFrame,
    checks: Sequence[Check],
    by: str | None = None,
    slices: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """One row per check (and per slice, with `by`): the columns of SCORE_COLUMNS after `slice`.

    Slices without rows have no row here, but for query checks, which give one for every value in `slices`
    (texts, or a DataFrame of distinct texts `slice`) where those are told.
    """
    by_kind: dict[str | None, list[Check]] = {}
    for check in checks:
        by_kind.setdefault(registry.kind(check), []).append(check)
    parts = []
    if "row" in by_kind:
        parts.append(_row_scores(batch, by_kind["row"], by))
    for check in by_kind.get("unique", []):
        parts.append(_unique_scores(batch, check, by))
    for check in by_kind.get("distinct", []):
        parts.append(_distinct_scores(batch, check, by))
    for check in by_kind.get("groups", []):
        parts.append(_group_scores(batch, check, by))
    for check in by_kind.get("query", []):
        parts.extend(_query_scores(batch, check, by, slices))
    if None in by_kind:
        parts.append(_unknown_scores(batch, by_kind[None], by))
    if not parts:
        raise CheckError("there is no check to run")
    return reduce(DataFrame.unionByName, parts)


def empty_score(check: Check) -> tuple:
    """SCORE_SCHEMA's values for a batch without rows (query checks always score themselves)."""
    kind = registry.kind(check)
    if kind == "distinct":
        return (check.config_id, True, 0, 0, 0, distinct_summary(0, 0))
    if kind == "groups":
        return (check.config_id, registry.expected_value(check) == 0, None, None, None, "0")
    if kind in ("row", "unique"):
        return (check.config_id, True, 0, 0, 0, None)
    return (check.config_id, None, None, None, None, UNKNOWN if kind is None else None)


def distinct_summary(scanned: int, failure: int) -> str:
    """`details` of a distinct-values check; the values themselves are rows of `observed_values`."""
    return f"{scanned} distinct values, {failure} outside the set"


DISTINCT_SUMMARY_SQL = "concat(scanned, ' distinct values, ', failure, ' outside the set')"

OBSERVED_SCHEMA = "slice string, config_id bigint, value string, outside boolean"


def observed_values(
    batch: DataFrame, checks: Sequence[Check], by: str | None = None
) -> DataFrame:
    """All distinct non-NULL values that the distinct-values checks among `checks` have seen, per slice,
    and whether each is outside the check's set. One row per value, however many there are."""
    parts = []
    for check in checks:
        if registry.kind(check) == "distinct":
            values, outside = _judged_values(batch, check, by)
            parts.append(
                registry.with_lookups(values, [outside]).select(
                    F.col("slice").cast("string") if by else F.lit(None).cast("string").alias("slice"),
                    F.lit(check.config_id).cast("bigint").alias("config_id"),
                    F.col("value").cast("string").alias("value"),
                    F.coalesce(outside.broken, F.lit(False)).alias("outside"),
                )
            )
    if not parts:
        return batch.sparkSession.createDataFrame([], OBSERVED_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def _judged_values(batch: DataFrame, check: Check, by: str | None):
    """The distinct values of a check's column, and the violation of its set by one of them."""
    column_type(batch, check.column)
    values = distinct_values(_conditioned(batch, check), check.column, by)
    on_values = Check(check.config_id, check.name, "value", check.params, check.text)
    return values, registry.violation(values, on_values)


def distinct_values(batch: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The distinct non-NULL values of a column (per slice)."""
    return (
        batch.filter(column(name).isNotNull())
        .select(*_slice(batch, by), column(name).alias("value"))
        .distinct()
    )


def _slice(batch: DataFrame, by: str | None) -> list[Column]:
    return [column(by).alias("slice")] if by else []


def _conditioned(batch: DataFrame, check: Check) -> DataFrame:
    return batch.filter(check.row_condition) if check.row_condition else batch


def _shaped(df: DataFrame, by: str | None, **values: str) -> DataFrame:
    """The columns of a score; `values` are SQL for those that `df` does not have as they are."""
    first = "slice" if by else "CAST(NULL AS string) AS slice"
    return df.selectExpr(first, *[f"{values.get(c, c)} AS {c}" for c in SCORE_COLUMNS])


def _row_scores(batch: DataFrame, checks: Sequence[Check], by: str | None) -> DataFrame:
    violations = [registry.violation(batch, c) for c in checks]
    joined = [v.check for v in violations if v.lookup is not None and not v.lookup.small]
    violations = [v for v in violations if v.lookup is None or v.lookup.small]
    parts = [_value_scores(batch, c, by) for c in joined]
    if violations:
        parts.append(_one_pass_scores(batch, violations, by))
    return reduce(DataFrame.unionByName, parts)


def _one_pass_scores(batch: DataFrame, violations: Sequence[registry.Violation], by: str | None) -> DataFrame:
    counts, rows = [], []
    for i, v in enumerate(violations):
        scope, name = v.check.row_condition, quoted(v.check.column)
        if scope:
            broken = F.expr(scope) & v.broken
            scanned = f"count_if({scope})"
            present = scanned if v.judges_nulls else f"count_if(({scope}) AND {name} IS NOT NULL)"
        else:
            broken = v.broken
            scanned = "count(1)"
            present = scanned if v.judges_nulls else f"count({name})"
        counts += [
            F.expr(f"{scanned} AS scanned_{i}"),
            F.expr(f"{present} AS present_{i}"),
            F.count_if(broken).alias(f"failure_{i}"),
        ]
        rows.append(
            f"named_struct('config_id', {v.check.config_id}L, 'scanned', scanned_{i}, "
            f"'present', present_{i}, 'failure', failure_{i}, 'mostly', {v.check.mostly}D)"
        )
    wide = (
        registry.with_lookups(batch, violations)
        .groupBy(*_slice(batch, by))
        .agg(*counts)
    )
    long = wide.selectExpr(*(["slice"] if by else []), f"inline(array({', '.join(rows)}))")
    return _shaped(
        long,
        by,
        expectation_status=f"({WITHIN_TOLERANCE})",
        success="scanned - failure",
        details="CAST(NULL AS string)",
    )


def _value_scores(batch: DataFrame, check: Check, by: str | None) -> DataFrame:
    """Scores of a check whose value set is too large to broadcast: the column's values are counted first and only these meet the
    set, each once, so no row is shuffled and no common value or NULL is a hot key."""
    scope = F.expr(check.row_condition) if check.row_condition else F.lit(True)
    counted = batch.groupBy(*_slice(batch, by), column(check.column).alias("value")).agg(F.count_if(scope).alias("n"))
    outside = registry.violation(counted, Check(check.config_id, check.name, "value", check.params, check.text))
    totals = (
        registry.with_lookups(counted, [outside])
        .groupBy(*(["slice"] if by else []))
        .agg(
            F.expr("coalesce(sum(n), 0L) AS scanned"),
            F.expr("coalesce(sum(n) FILTER (WHERE value IS NOT NULL), 0L) AS present"),
            F.coalesce(F.sum(F.when(outside.broken, F.col("n"))), F.lit(0).cast("bigint")).alias("failure"),
        )
    )
    return _shaped(
        totals.withColumn("mostly", F.lit(check.mostly)),
        by,
        config_id=f"{check.config_id}L",
        expectation_status=f"({WITHIN_TOLERANCE})",
        success="scanned - failure",
        details="CAST(NULL AS string)",
    )


def _unique_scores(batch: DataFrame, check: Check, by: str | None) -> DataFrame:
    registry.repeated_row_options(batch, check)
    totals = (
        _conditioned(batch, check)
        .groupBy(*_slice(batch, by), group_key(batch, check.column).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*(["slice"] if by else []))
        .agg(
            F.expr("coalesce(sum(n), 0L) AS scanned"),
            F.expr("coalesce(sum(n) FILTER (WHERE key IS NOT NULL), 0L) AS present"),
            F.expr("coalesce(sum(n) FILTER (WHERE key IS NOT NULL AND n > 1), 0L) AS failure"),
        )
    )
    return _shaped(
        totals.withColumn("mostly", F.lit(check.mostly)),
        by,
        config_id=f"{check.config_id}L",
        expectation_status=f"({WITHIN_TOLERANCE})",
        success="scanned - failure",
        details="CAST(NULL AS string)",
    )


def _distinct_scores(batch: DataFrame, check: Check, by: str | None) -> DataFrame:
    values, outside = _judged_values(batch, check, by)
    totals = (
        registry.with_lookups(values, [outside])
        .groupBy(*(["slice"] if by else []))
        .agg(F.count(F.lit(1)).alias("scanned"), F.count_if(outside.broken).alias("failure"))
    )
    return _shaped(
        totals,
        by,
        config_id=f"{check.config_id}L",
        expectation_status="failure = 0",
        success="scanned - failure",
        details=DISTINCT_SUMMARY_SQL,
    )


def duplicate_group_counts(batch: DataFrame, check: Check, by: str | None = None) -> DataFrame:
    """What a duplicate-group check sees (per slice): `observed`, the rows of the largest group of more than
    one row (0 without any), `groups`, how many such groups there are, and `met`."""
    columns = check.params.get("columns")
    if not isinstance(columns, list) or not columns:
        raise CheckError("columns must be a list of column names")
    value = registry.expected_value(check)
    return (
        _conditioned(batch, check)
        .groupBy(*_slice(batch, by), *[group_key(batch, c).alias(f"g{i}") for i, c in enumerate(columns)])
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*(["slice"] if by else []))
        .agg(
            F.expr("coalesce(max(n) FILTER (WHERE n > 1), 0L) AS observed"),
            F.expr("count_if(n > 1) AS groups"),
        )
        .withColumn("met", F.col("observed") == value)
    )


def _group_scores(batch: DataFrame, check: Check, by: str | None) -> DataFrame:
    return _observed(duplicate_group_counts(batch, check, by), check, by)


def _observed(df: DataFrame, check: Check, by: str | None) -> DataFrame:
    """Scores of a check that only observes a value: `observed`, and `met` for its success."""
    none = "CAST(NULL AS bigint)"
    return _shaped(
        df,
        by,
        config_id=f"{check.config_id}L",
        expectation_status="coalesce(met, false)",
        scanned=none,
        success=none,
        failure=none,
        details="CAST(observed AS string)",
    )


def _query_scores(
    batch: DataFrame, check: Check, by: str | None, slices: Sequence[str] | DataFrame | None
) -> list[DataFrame]:
    query = registry.query_check(check)
    batch = _conditioned(batch, check)
    if registry.GROUP in query.sql:
        return [_query_by_group(batch, check, query, by, slices)]
    if by is None:
        return [_query_score(batch, check, query)]
    lateral = _query_per_slice(batch, check, query, by, slices)
    if lateral is None:
        raise CheckError(
            "the query cannot be run for all slices at once: it needs an aggregate or a limit over {active_batch} "
            "that Spark can group by the run column, or {group}, which names it, among its columns and groups"
        )
    return [lateral]


def _query_by_group(
    batch: DataFrame, check: Check, query, by: str | None, slices: Sequence[str] | DataFrame | None
) -> DataFrame:
    """Scores of a query that does its own grouping: its columns are `{group}` and what it observes there.

    One pass whatever the number of slices. A whole table is one group. A slice for which the query gives no row has
    nothing observed; of several rows the least counts.
    """
    spark = batch.sparkSession
    group = by or free_names(batch.columns, ["__group"])[0]
    rows = batch if by else batch.withColumn(group, F.lit(1))
    result = _by_position(spark.sql(query.sql.replace(registry.GROUP, quoted(group)), active_batch=rows))
    if len(result.columns) < 2:
        raise CheckError("a query with {group} must give the group and a value")
    seen = result.groupBy(F.col("c0").alias("slice")).agg(F.min("c1").alias("observed"))
    if by is None:
        seen = seen.agg(F.min("observed").alias("observed"))
    else:
        seen = _wanted_slices(batch, by, slices).join(seen, "slice", "left")
    return _observed(seen.withColumn("met", query.success(F.col("observed"), check.params)), check, by)


def _wanted_slices(batch: DataFrame, by: str, slices: Sequence[str] | DataFrame | None) -> DataFrame:
    """The distinct `slice` values that are asked for, in the run column's type; all there are where none are told."""
    if slices is None:
        return batch.select(column(by).alias("slice")).filter("slice IS NOT NULL").distinct()
    if not isinstance(slices, DataFrame):
        slices = local_frame(batch.sparkSession, [(s,) for s in slices], "slice string")
    return slices.select(F.col("slice").cast(column_type(batch, by)).alias("slice"))


def _query_score(batch: DataFrame, check: Check, query) -> DataFrame:
    spark = batch.sparkSession
    result = spark.sql(query.sql, active_batch=batch)
    cell = _by_position(result).select(F.col("c0").alias("observed")).limit(1)
    # A global aggregate gives its one row also where the query gives none.
    seen = cell.agg(F.first("observed").alias("observed"))
    return _observed(seen.withColumn("met", query.success(F.col("observed"), check.params)), check, None)


def _by_position(result: DataFrame) -> DataFrame:
    """Columns named by their place: a query may give two of one name."""
    return result.toDF(*[f"c{i}" for i in range(len(result.columns))])


def _query_per_slice(
    batch: DataFrame, check: Check, query, by: str, slices: Sequence[str] | DataFrame | None
) -> DataFrame | None:
    """The query's first cell for every slice, in one pass: a lateral subquery that Spark turns into a grouping.
    None where it cannot."""
    spark, rows, wanted = batch.sparkSession, f"rows_{uuid4().hex}", f"slices_{uuid4().hex}"
    names = [f"c{i}" for i in range(len(spark.sql(query.sql, active_batch=batch).columns))]
    values = _wanted_slices(batch, by, slices)
    batch.createOrReplaceTempView(rows)
    values.createOrReplaceTempView(wanted)
    own = f"(SELECT * FROM {rows} WHERE {rows}.{quoted(by)} = {wanted}.slice)"
    try:
        sql = query.sql.replace("{active_batch}", own)
        seen = spark.sql(
            f"SELECT {wanted}.slice, q.c0 AS observed FROM {wanted} LEFT JOIN LATERAL "
            f"(SELECT c0 FROM ({sql}) AS found({', '.join(names)}) LIMIT 1) AS q"
        )
        seen._jdf.queryExecution().optimizedPlan()  # what cannot be decorrelated raises here
    except AnalysisException:
        return None
    finally:
        spark.catalog.dropTempView(rows)
        spark.catalog.dropTempView(wanted)
    return _observed(
        seen.withColumn("met", query.success(F.col("observed"), check.params)), check, by
    )


def _unknown_scores(batch: DataFrame, checks: Sequence[Check], by: str | None) -> DataFrame:
    """A row without status for each unknown name; per slice where there are slices."""
    if not by:
        scores = [empty_score(c) for c in checks]
        return _shaped(local_frame(batch.sparkSession, scores, SCORE_SCHEMA), None)
    ids = ", ".join(f"{c.config_id}L" for c in checks)
    slices = batch.select(*_slice(batch, by)).distinct()
    none = "CAST(NULL AS bigint)"
    return _shaped(
        slices.selectExpr("slice", f"explode(array({ids})) AS config_id"),
        by,
        expectation_status="CAST(NULL AS boolean)",
        scanned=none,
        success=none,
        failure=none,
        details=f"'{UNKNOWN}'",
    )
