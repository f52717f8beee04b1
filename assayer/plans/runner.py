"""Running all pending jobs.

The driver sees the check configuration and nothing that grows with the data. Jobs that want the same
checks of one table are one unit: all jobs on the whole table, or all run slices by one run column.
A unit scores all its slices in the same scans, so a ledger of a thousand slices of a table costs what
one costs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import cached_property, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.columns import column, column_type, free_names, typed_literal
from assayer.functions.metrics import passed_message
from assayer.model import Check, CheckError, Control
from assayer.operators import registry
from assayer.operators.failed import config_name, failed_schema, tag_names, tagged_rows
from assayer.operators.scorecard import SCORE_SCHEMA, empty_score, observed_values, scorecard
from assayer.plans import control as C
from assayer.plans import details as D
from assayer.sources import sinks
from assayer.sources.local import local_frame
from assayer.sources.tables import Tables

# Up to this many jobs of a unit are read by the driver, and their slices become an IN filter that
# prunes files and partitions; more stay a DataFrame. Their distinct slices are picked by a semi join within the
# range of the least and the greatest, which prunes too, and broadcast up to BROADCAST_BYTES as measured.
# (Below the 1,000 up to which Spark limits a window's groups before it shuffles them.)
LOCAL_JOBS = 500
BROADCAST_BYTES = 64 << 20
CONCURRENT_UNITS = 4

UNIT = ["schema_name", "table_name", "full_table", "run_column"]
SCORED = ["expectation_status", "scanned", "success", "failure", "details"]
UNIT_JOBS_SCHEMA = "unit int, job_id bigint, slice string"
UNIT_CHECKS_SCHEMA = (
    "unit int, schema_name string, table_name string, expectation_name string, "
    f"column_name string, {SCORE_SCHEMA}"
)
PLANNED_SCHEMA = f"{UNIT_JOBS_SCHEMA}, {UNIT_CHECKS_SCHEMA.removeprefix('unit int, ')}"
OUTCOME_SCHEMA = "job_id bigint, run_id string, job_status string, status_msg string"
DETAILS_SCHEMA = (
    "run_id string, job_id bigint, expectation_name string, schema_name string, "
    f"table_name string, column_name string, {SCORE_SCHEMA}"
)
PLAN_SCHEMA = (
    "run_id string, job_id bigint, job_name string, config_id bigint, exp_id bigint, "
    "schema_name string, table_name string, column_name string, expectation_name string, "
    "expectation_parameters string"
)
OBSERVED_SCHEMA = (
    "run_id string, job_id bigint, config_id bigint, expectation_name string, column_name string, "
    "slice string, value string, outside boolean"
)
SUITE_METRICS_SCHEMA = "run_id string, job_id bigint, metric string, value string"
METRICS_SCHEMA = (
    "run_id string, job_id bigint, config_id bigint, expectation_name string, column_name string, "
    "metric string, value string"
)


@dataclass
class Unit:
    """The jobs of one table that share their checks, ready to score."""

    number: int
    schema: str
    table: str
    by: str | None
    batch: DataFrame
    jobs: DataFrame  # UNIT_JOBS_SCHEMA; `slice` is empty text without `by`
    checks: list[Check]
    invalid: dict[int, str]  # config id -> why the check cannot run
    scores: DataFrame | None  # of the usable checks
    few_slices: bool
    slices: Sequence[str] | DataFrame | None = None
    local_jobs: list[int] | None = None  # up to LOCAL_JOBS

    @property
    def name(self) -> str:
        """Names the unit's folder among its table's results."""
        return f"slices of {self.by}" if self.by else "full"

    def usable(self) -> list[Check]:
        return [c for c in self.checks if c.config_id not in self.invalid]

    def planned(self) -> list[tuple]:
        """UNIT_CHECKS_SCHEMA rows: the checks, scored as for a batch without rows."""
        rows = []
        for c in self.checks:
            if c.config_id in self.invalid:
                score = (c.config_id, None, None, None, None, D.INVALID + self.invalid[c.config_id])
            else:
                score = empty_score(c)
            rows.append((self.number, self.schema, self.table, c.name, c.column, *score))
        return rows

    def observed(self, run_id: str) -> DataFrame:
        """OBSERVED_SCHEMA rows: every value that the distinct-values checks have seen, per job."""
        spark = self.batch.sparkSession
        checks = [c for c in self.usable() if registry.kind(c) == "distinct"]
        if not checks:
            return spark.createDataFrame([], OBSERVED_SCHEMA)
        seen = observed_values(self.batch, checks, self.by)
        seen = seen.withColumn("slice", F.coalesce("slice", F.lit("")))
        if self.by is None and self.local_jobs is not None:
            seen = seen.withColumn("job_id", F.explode(F.array(*map(F.lit, self.local_jobs))))
        else:
            seen = seen.join(self.jobs.select("job_id", "slice"), "slice")

        def named(values: list[str]) -> Column:
            pairs = [x for c, v in zip(checks, values) for x in (F.lit(c.config_id).cast("bigint"), F.lit(v))]
            return F.element_at(F.create_map(*pairs), F.col("config_id"))

        return seen.select(
            F.lit(run_id).alias("run_id"),
            F.col("job_id").cast("bigint").alias("job_id"),
            "config_id",
            named([c.name for c in checks]).alias("expectation_name"),
            named([c.column for c in checks]).alias("column_name"),
            "slice",
            "value",
            "outside",
        )

    def without_failing(self, error: Exception) -> None:
        """After `error`, find the checks that raise: they become invalid, the others keep their scores. Raises
        `error` again if no check by itself is to blame, or all of them are."""
        bad: dict[int, str] = {}
        for job in (self._scoring, self._tagging):
            bad |= _culprits([c for c in self.usable() if c.config_id not in bad], job)
        if not bad or len(bad) == len(self.usable()):  # then it is not a check but the table
            raise error
        self.invalid.update(bad)
        self.scores = _scores(self.batch, self.checks, self.invalid, self.by, self.slices)

    def _scoring(self, checks: list[Check]) -> None:
        scores = _scores(self.batch, checks, {}, self.by, self.slices)
        if scores is not None:
            scores.write.format("noop").mode("overwrite").save()

    def _tagging(self, checks: list[Check]) -> None:
        tagged_rows(self.batch, checks, self.by, "extra").write.format("noop").mode("overwrite").save()

    def each_check(self) -> Column:
        """Repeats a job's row for every check: the checks are configuration, so this needs no join."""
        fields = T.StructType.fromDDL(UNIT_CHECKS_SCHEMA).fields[1:]
        rows = [
            F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row[1:], fields)])
            for row in self.planned()
        ]
        return F.inline(F.array(*rows))

    def failed(
        self, run_id: str, unique_mode: str, details: DataFrame | None = None
    ) -> DataFrame:
        """Rows that broke a failed check. With the unit's saved `details` only the checks that did
        fail are looked at; without, which ones failed is found in the same query."""
        checks = self.usable()
        failing, failures = None, {}
        if details is not None:
            failed = F.count_if(~F.col("expectation_status")).alias("failed")
            counted = details.groupBy("config_id").agg(failed, F.sum("failure").alias("rows"))
            failures = {r["config_id"]: r["rows"] for r in counted.filter("failed > 0").collect()}
            checks = [c for c in checks if c.config_id in failures]
            failing = details.filter(~F.col("expectation_status")).join(self.jobs, "job_id")
            failing = failing.select("config_id", "slice").distinct()
        if not any(registry.kind(c) in ("row", "distinct", "unique") for c in checks):
            return self.batch.sparkSession.createDataFrame([], failed_schema(self.batch.schema))
        rows = tagged_rows(self.batch, checks, self.by, unique_mode, failures)
        # Only with a tolerance may a check succeed in spite of violations; that of a whole table,
        # once known, is left out above.
        if any(c.mostly < 1 for c in checks) and (self.by or failing is None):
            rows = self._of_failed_checks(rows, failing)
        run_tag = tag_names(self.batch.columns)[2]
        return rows.drop(config_name(self.batch.columns)).withColumn(run_tag, F.lit(run_id))

    def _of_failed_checks(self, rows: DataFrame, failing: DataFrame | None) -> DataFrame:
        if failing is None:
            failing = self.scores.filter(~F.col("expectation_status"))
        config, slice_ = free_names(rows.columns, ["__failing", "__slice"])
        failing = failing.select(F.col("config_id").alias(config), F.col("slice").alias(slice_))
        if self.few_slices:  # at most LOCAL_JOBS rows per check
            failing = F.broadcast(failing)
        on = F.col(config_name(self.batch.columns)) == F.col(config)
        if self.by:
            on = on & (column(self.by).cast("string") == F.col(slice_))
        return rows.join(failing, on, "left_semi")


def _culprits(checks: list[Check], job: Callable[[list[Check]], None], raises: bool = False) -> dict[int, str]:
    """The checks that make `job` raise, with their errors: by halves, so one culprit of n costs some log n jobs.
    `raises` where it is known that some of them do. None where they raise together only."""
    if not checks:
        return {}
    if not raises or len(checks) == 1:
        try:
            job(checks)
            return {}
        except Exception as error:  # whatever it is, it is these checks'
            if len(checks) == 1:
                return {checks[0].config_id: str(error)}
    half = len(checks) // 2
    bad = _culprits(checks[:half], job)
    return bad | _culprits(checks[half:], job, raises=not bad)


def _details(spark: SparkSession, units: Sequence[Unit], run_id: str) -> DataFrame:
    """One row per job and check of the units; what has no score has that of an empty batch."""
    planned = _union([u.jobs.select("*", u.each_check()) for u in units], spark, PLANNED_SCHEMA)
    planned = planned.select("*", F.struct(*SCORED).alias("empty")).drop(*SCORED)
    scores = [
        u.scores.select(
            F.lit(u.number).alias("unit"),
            F.coalesce("slice", F.lit("")).alias("slice"),
            "config_id",
            F.struct(*SCORED).alias("score"),
        )
        for u in units
        if u.scores is not None
    ]
    if scores:
        keys = ["unit", "slice", "config_id"]
        planned = planned.join(reduce(DataFrame.unionByName, scores), keys, "left")
    else:
        planned = planned.withColumn("score", F.col("empty"))
    score = F.when(F.col("score").isNull(), F.col("empty")).otherwise(F.col("score"))
    return planned.withColumn("score", score).select(
        F.lit(run_id).alias("run_id"),
        "job_id",
        "expectation_name",
        "schema_name",
        "table_name",
        "column_name",
        "config_id",
        *[F.col("score").getField(c).alias(c) for c in SCORED],
    )


def job_outcomes(details: DataFrame) -> DataFrame:
    """How each job ended: `Failed` where some check could not be run at all."""
    is_invalid = F.col("expectation_status").isNull() & F.startswith("details", F.lit(D.INVALID))
    counted = details.groupBy("job_id", "run_id").agg(
        F.count("expectation_status").alias("evaluated"),
        F.count_if("expectation_status").alias("successful"),
        F.array_sort(F.collect_list(F.when(is_invalid, F.col("config_id")))).alias("invalid"),
    )
    message = passed_message(F.col("successful"), F.col("evaluated"))
    invalid = F.concat(
        F.lit("; invalid checks: "), F.array_join(F.col("invalid").cast("array<string>"), ", ")
    )
    return counted.select(
        "job_id",
        "run_id",
        F.when(F.size("invalid") > 0, "Failed").otherwise("Success").alias("job_status"),
        F.when(F.size("invalid") > 0, F.concat(message, invalid))
        .otherwise(message)
        .alias("status_msg"),
    )


@dataclass
class Results:
    """What a run gives. Everything is lazy until it is used or saved."""

    spark: SparkSession
    run_id: str
    jobs: DataFrame
    checks: DataFrame  # PLAN_SCHEMA: what is checked for which job
    unique_mode: str
    started: datetime
    ended: datetime | None = None
    units: list[Unit] = field(default_factory=list)
    broken: list[DataFrame] = field(default_factory=list)  # outcomes of jobs that cannot be run
    errors: dict[str, str] = field(default_factory=dict)

    @cached_property
    def details(self) -> DataFrame:
        return _details(self.spark, self.units, self.run_id)

    @property
    def observed(self) -> DataFrame:
        """All values that distinct-values checks have seen."""
        return _union([u.observed(self.run_id) for u in self.units], self.spark, OBSERVED_SCHEMA)

    @property
    def metrics(self) -> DataFrame:
        return D.metrics_long(self.details, self.observed)

    @property
    def statistics(self) -> DataFrame:
        return D.suite_statistics(self.details)

    @property
    def failed(self) -> dict[tuple[str, str, str], DataFrame]:
        """Violating rows by (schema, table, unit): tables differ in their columns."""
        return {
            (u.schema, u.table, u.name): u.failed(self.run_id, self.unique_mode)
            for u in self.units
        }

    @property
    def ledger(self) -> DataFrame:
        outcomes = [job_outcomes(self.details), *self.broken]
        return C.ledger_transition(self.jobs, self._timed(outcomes, self.started))

    def _timed(
        self, outcomes: Sequence[DataFrame], started: datetime, ended: datetime | None = None
    ) -> DataFrame:
        """Outcomes with their times. Without an end they end when they are computed."""
        ended = self.ended or ended
        end = F.current_timestamp() if ended is None else F.lit(ended)
        return _union(outcomes, self.spark, OUTCOME_SCHEMA).withColumns(
            {"execution_start_time": F.lit(started), "execution_end_time": end}
        )

    def save(self, base: str, concurrent_units: int = CONCURRENT_UNITS) -> DataFrame:
        """Write the planned checks, details, observed values, metrics of checks and suites, violating rows
        and the ledger's next snapshot under `base`, a folder that all executors share.

        Each unit is written by itself, some at a time. Where one raises, its checks are tried one by one: those
        that raise end as invalid and the others are written. If that fails too, its jobs end as
        `Failed` and nothing of it is left. Gives the ledger snapshot.
        """
        sinks.write_partition(self.checks, f"{base}/checks", run_id=self.run_id)
        target = inheritable_thread_target(self.spark)(lambda unit: self._save_unit(unit, base))
        with ThreadPoolExecutor(concurrent_units) as pool:
            outcomes = list(pool.map(target, self.units))
        if self.broken:
            outcomes.append(self._timed(self.broken, self.started, datetime.now(timezone.utc)))
        ledger = self.jobs
        if outcomes:
            ledger = C.ledger_transition(ledger, reduce(DataFrame.unionByName, outcomes))
        sinks.write_ledger(ledger, base, self.run_id, self.jobs)
        return sinks.read_ledger(self.spark, base, self.run_id)

    def _save_unit(self, unit: Unit, base: str) -> DataFrame:
        started = datetime.now(timezone.utc) if self.ended is None else self.started
        label = f"{unit.schema}.{unit.table} {unit.name}"
        try:
            try:
                outcomes = self._write_unit(unit, base, label)
            except Exception as error:  # of one check, perhaps
                unit.without_failing(error)
                outcomes = self._write_unit(unit, base, label)
        except Exception as error:  # whatever it is, it is this unit's
            self.errors[label] = str(error)
            self._clear_unit(unit, base, label)
            outcomes = _failed_jobs(unit.jobs, self.run_id, str(error))
        return self._timed([outcomes], started, datetime.now(timezone.utc))

    def _write_unit(self, unit: Unit, base: str, label: str) -> DataFrame:
        place = {"run_id": self.run_id, sinks.BATCH: label}

        def saved(folder: str, schema: str) -> DataFrame:
            return sinks.read_partition(self.spark, f"{base}/{folder}", schema, **place)

        scored = _details(self.spark, [unit], self.run_id)
        sinks.write_partition(scored, f"{base}/details", **place)
        sinks.write_partition(unit.observed(self.run_id), f"{base}/observed", **place)
        details, observed = saved("details", DETAILS_SCHEMA), saved("observed", OBSERVED_SCHEMA)
        sinks.write_partition(D.metrics_long(details, observed), f"{base}/metrics", **place)
        suites = D.suite_metrics_long(D.suite_statistics(details))
        sinks.write_partition(suites, f"{base}/suite_metrics", **place)
        path, names = self._failed_place(unit, base)
        failed = unit.failed(self.run_id, self.unique_mode, details)
        sinks.write_partition(failed, path, **names)
        return job_outcomes(details)

    def _clear_unit(self, unit: Unit, base: str, label: str) -> None:
        """Leave no results of a unit that failed, neither of this attempt nor of one before."""
        place = {"run_id": self.run_id, sinks.BATCH: label}
        schemas = {
            "details": DETAILS_SCHEMA,
            "observed": OBSERVED_SCHEMA,
            "metrics": METRICS_SCHEMA,
            "suite_metrics": SUITE_METRICS_SCHEMA,
        }
        for folder, schema in schemas.items():
            none = self.spark.createDataFrame([], schema)
            sinks.write_partition(none, f"{base}/{folder}", **place)
        path, names = self._failed_place(unit, base)
        none = self.spark.createDataFrame([], failed_schema(unit.batch.schema))
        sinks.write_partition(none, path, **names)

    def _failed_place(self, unit: Unit, base: str) -> tuple[str, dict[str, str]]:
        """Folder of a unit's violating rows and its partition, under names that its columns leave free."""
        run_tag = tag_names(unit.batch.columns)[2]
        tagged = [*unit.batch.columns, *tag_names(unit.batch.columns)]
        batch = free_names(tagged, [sinks.BATCH])[0]
        return f"{base}/failed/{unit.schema}.{unit.table}", {run_tag: self.run_id, batch: unit.name}

    def _saved(self, base: str, folder: str, schema: str) -> DataFrame:
        return sinks.read_run(self.spark, f"{base}/{folder}", schema, run_id=self.run_id)

    def saved_details(self, base: str) -> DataFrame:
        """The run's details as saved, with the unit they come from."""
        return self._saved(base, "details", DETAILS_SCHEMA)

    def saved_metrics(self, base: str) -> DataFrame:
        return self._saved(base, "metrics", METRICS_SCHEMA)

    def saved_suite_metrics(self, base: str) -> DataFrame:
        return self._saved(base, "suite_metrics", SUITE_METRICS_SCHEMA)

    def saved_observed(self, base: str) -> DataFrame:
        return self._saved(base, "observed", OBSERVED_SCHEMA)

    def saved_checks(self, base: str) -> DataFrame:
        return sinks.read_partition(self.spark, f"{base}/checks", PLAN_SCHEMA, run_id=self.run_id)

    def saved_failed(self, base: str, unit: Unit) -> DataFrame:
        path, names = self._failed_place(unit, base)
        return sinks.read_partition(self.spark, path, failed_schema(unit.batch.schema), **names)


def run_jobs(
    spark: SparkSession,
    control: Control,
    tables: Tables,
    run_id: str,
    started: datetime | None = None,
    ended: datetime | None = None,
    unique_mode: str = "extra",
) -> Results:
    """Plan all pending jobs under `run_id`.

    `tables(schema, table)` gives a table's DataFrame. A job that cannot be planned ends as `Failed`
    in the ledger; it does not stop others.
    """
    pending = C.pending_jobs(control.jobs).withColumn(
        "run_column", F.when(F.col("full_table") == 0, F.col("pipeline_run_id_name"))
    )
    active = C.active_checks(control.config, control.checks)
    plan = C.job_plan(active, pending)
    # Which units there are and which jobs have a check is told by tables, not by jobs times checks.
    units = C.job_plan(active, pending.select(*UNIT).distinct())
    checked = active.filter(F.col("expectation_name").isNotNull()).select("schema_name", "table_name")
    planned_jobs = pending.join(checked.distinct(), ["schema_name", "table_name"], "left_semi")

    checks = plan.select(
        F.lit(run_id).alias("run_id"), *T.StructType.fromDDL(PLAN_SCHEMA).names[1:]
    )
    started = started or datetime.now(timezone.utc)
    results = Results(spark, run_id, control.jobs, checks, unique_mode, started, ended)
    local_jobs = _local_jobs(planned_jobs)
    for number, (key, rows) in enumerate(_checks_by_unit(units).items()):
        few = local_jobs[key] if len(local_jobs[key]) <= LOCAL_JOBS else None
        if few is None:
            same = zip(UNIT, key)
            jobs = planned_jobs.filter(
                reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in same])
            )
        else:
            jobs = local_frame(spark, few, "job_id bigint, pipeline_run_id string")
        try:
            results.units.append(_unit(results, number, key, rows, jobs, few, tables))
        except Exception as error:  # of a table's source, say: it ends this unit only
            results.errors[f"{key[0]}.{key[1]}"] = str(error)
            results.broken.append(_failed_jobs(jobs, run_id, str(error)))
    return results


def _checks_by_unit(plan: DataFrame) -> dict[tuple, list]:
    """The configuration to run: as many rows as there are active checks per table and run column,
    however many jobs and rows stand behind them."""
    rows = (
        plan.select(
            *UNIT, "config_id", "column_name", "expectation_parameters", "expectation_name"
        )
        .distinct()
        .collect()
    )
    units: dict[tuple, list] = {}
    for row in sorted(rows, key=lambda r: (*[str(r[c]) for c in UNIT], r["config_id"])):
        units.setdefault(tuple(row[c] for c in UNIT), []).append(row)
    return units


def _local_jobs(jobs: DataFrame) -> dict[tuple, list]:
    """Up to LOCAL_JOBS + 1 jobs of each unit; one more than LOCAL_JOBS tells that there are more."""
    place = F.row_number().over(Window.partitionBy(*UNIT).orderBy("job_id"))
    rows = (
        jobs.select(*UNIT, "job_id", "pipeline_run_id", place.alias("place"))
        .filter(F.col("place") <= LOCAL_JOBS + 1)
        .collect()
    )
    units: dict[tuple, list] = {}
    for row in rows:
        units.setdefault(tuple(row[c] for c in UNIT), []).append(
            (row["job_id"], row["pipeline_run_id"])
        )
    return units


def _unit(results, number, key, rows, jobs, few, tables) -> Unit:
    """A unit from its configuration rows and jobs; `few` are the jobs where they are local."""
    schema, table, full_table, by = key
    if full_table not in (0, 1):
        raise CheckError(f"full_table must be 0 or 1, not {full_table!r}")
    if full_table == 0 and by is None:
        raise CheckError("a run slice needs the name of its run column")
    batch = tables(schema, table)
    slices = None
    if by is None:
        jobs = jobs.select("job_id", F.lit("").alias("slice"))
    else:
        dtype = column_type(batch, by)
        jobs, bad = _slices_of(results.spark, jobs, few, dtype)
        if bad is not None:
            why = f"no value of run column {by} ({dtype.simpleString()})"
            results.broken.append(_failed_jobs(bad, results.run_id, why))
        if few is not None:
            slices = sorted({r["slice"] for r in jobs.select("slice").distinct().collect()})
        batch = _sliced(batch, by, dtype, jobs, slices)
    jobs = jobs.select(F.lit(number).alias("unit"), "job_id", "slice")
    checks, invalid = _parsed(rows)
    if by and slices is None:
        slices = jobs.select("slice").distinct()
    scores = _scores(batch, checks, invalid, by, slices)
    few_slices = by is None or few is not None
    ids = None if few is None else [job_id for job_id, _ in few]
    return Unit(
        number, schema, table, by, batch, jobs, checks, invalid, scores, few_slices, slices, ids
    )


def _slices_of(spark, jobs, few, dtype) -> tuple[DataFrame, DataFrame | None]:
    """job_id and `slice` as the run column spells it, and the jobs whose slice it cannot hold."""
    if few is not None and isinstance(dtype, T.StringType):
        good = [(i, text) for i, text in few if text is not None]
        bad = [(i,) for i, text in few if text is None]
        return (
            local_frame(spark, good, "job_id bigint, slice string"),
            local_frame(spark, bad, "job_id bigint") if bad else None,
        )
    spelled = F.col("pipeline_run_id").try_cast(dtype).cast("string").alias("slice")
    jobs = jobs.select("job_id", spelled)
    return jobs.filter(F.col("slice").isNotNull()), jobs.filter(F.col("slice").isNull())


def _sliced(batch, by, dtype, jobs, slices) -> DataFrame:
    if slices is None:
        name = free_names(batch.columns, ["__wanted"])[0]
        wanted = jobs.select(F.col("slice").cast(dtype).alias(name)).distinct()
        size = F.coalesce(F.sum(F.octet_length(F.col(name).cast("string")) + 64), F.lit(0))
        seen = wanted.agg(F.min(name).cast("string"), F.max(name).cast("string"), size).first()
        if seen[0] is None:
            return batch.filter(F.lit(False))
        if seen[2] <= BROADCAST_BYTES:
            wanted = F.broadcast(wanted)
        least, most = (typed_literal(text, dtype) for text in seen[:2])
        within = batch.filter(column(by).between(least, most))
        return within.join(wanted, column(by) == F.col(name), "left_semi")
    if not slices:
        return batch.filter(F.lit(False))
    return batch.filter(column(by).isin(*[typed_literal(text, dtype) for text in slices]))


def _parsed(rows: Sequence) -> tuple[list[Check], dict[int, str]]:
    """Checks of the configuration rows, and why some of them cannot run."""
    checks, invalid = [], {}
    for row in rows:
        try:
            check = Check.from_row(row)
            check.mostly, check.row_condition
        except CheckError as error:
            text = row["expectation_parameters"]
            check = Check(row["config_id"], row["expectation_name"], row["column_name"], {}, text)
            invalid[row["config_id"]] = str(error)
        checks.append(check)
    return checks, invalid


def _scores(batch, checks, invalid, by, slices) -> DataFrame | None:
    """Scores of the checks that Spark can analyse; adds the others to `invalid`."""

    def build(some: list[Check]) -> DataFrame:
        scores = scorecard(batch, some, by, slices)
        return scores.withColumn("slice", F.col("slice").cast("string"))

    # Unknown names are planned without a status and need no look at the table.
    known = [c for c in checks if registry.kind(c) is not None]
    usable = [c for c in known if c.config_id not in invalid]
    try:
        return build(usable) if usable else None
    except Exception:  # registered checks may raise anything
        for check in usable:
            try:
                build([check])
            except Exception as error:
                invalid[check.config_id] = str(error)
    usable = [c for c in usable if c.config_id not in invalid]
    return build(usable) if usable else None


def _failed_jobs(jobs: DataFrame, run_id: str, message: str) -> DataFrame:
    return jobs.select(
        "job_id",
        F.lit(run_id).alias("run_id"),
        F.lit("Failed").alias("job_status"),
        F.lit(message).alias("status_msg"),
    )


def _union(frames: Sequence[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, frames)
