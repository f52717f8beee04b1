"""Control tables that grow with the data: ledgers, configurations and metrics derived from the test
tables by Spark, and the same as SQL common table expressions.

Each order is a job, each customer a configured check, each nation an entry of the check catalogue,
each line item a check result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.model import (
    CONTAINS,
    DISTINCT_IN_SET,
    IN_SET,
    LENGTH,
    LIKE,
    NOT_NULL,
    QUERIED_UNIQUE,
    UNIQUE,
)

NAMES = [
    NOT_NULL,
    IN_SET,
    DISTINCT_IN_SET,
    UNIQUE,
    LENGTH,
    LIKE,
    CONTAINS,
    QUERIED_UNIQUE,
    "no_such_check",
]
COLUMNS = ["automobile", "building", "furniture", "household", "machinery"]

_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
_COLUMNS_SQL = "[" + ", ".join(f"'{n}'" for n in COLUMNS) + "]"


def _pick(values: list[str], index: str):
    return F.get(F.array(*map(F.lit, values)), F.expr(f"cast({index} as int)"))


def checks(nation: DataFrame) -> DataFrame:
    """The catalogue; every tenth entry has no name."""
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("exp_id"),
        _pick(NAMES, "n_nationkey % 10").alias("expectation_name"),
    )


def config(customer: DataFrame) -> DataFrame:
    """Three configured checks per table, some inactive, some without a column."""
    segment = F.col("c_mktsegment")
    kind = F.col("c_custkey") % 6
    params = (
        F.when(kind == 0, F.format_string('{"value_set":["%s","NONE"]}', segment))
        .when(kind == 1, F.format_string('{"value":%d}', "c_nationkey"))
        .when(kind == 2, F.format_string('{"like_pattern":"%%%s"}', segment))
        .when(kind == 3, F.format_string('{"substring":"%s","mostly":0.9}', segment))
        .when(kind == 4, F.lit('{"columns":["a","b"],"value":0}'))
        .otherwise(F.lit('{"row_condition":"a > 1"}'))
    )
    return customer.select(
        F.col("c_custkey").alias("config_id"),
        F.col("c_nationkey").cast("bigint").alias("exp_id"),
        F.lit("main").alias("schema_name"),
        F.expr("concat('table_', c_custkey div 3)").alias("table_name"),
        F.when(segment != "MACHINERY", F.lower(segment)).alias("column_name"),
        params.alias("expectation_parameters"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("flag"),
    )


def jobs(orders: DataFrame) -> DataFrame:
    """The ledger: open, successful and failed jobs, on whole tables and on slices."""
    is_open = F.col("o_orderstatus") == "O"
    sliced = F.col("o_orderpriority") == "5-LOW"
    return orders.select(
        F.col("o_orderkey").alias("job_id"),
        F.expr("concat('job_', o_custkey)").alias("job_name"),
        F.lit("main").alias("schema_name"),
        F.expr("concat('table_', o_custkey div 3)").alias("table_name"),
        F.when(sliced, 0)
        .when(F.col("o_orderpriority") != "4-NOT SPECIFIED", 1)
        .alias("full_table"),
        F.when(sliced, F.lit("load_month")).alias("pipeline_run_id_name"),
        F.when(sliced, F.date_format("o_orderdate", "yyyy-MM")).alias("pipeline_run_id"),
        F.when(~is_open | (F.col("o_orderkey") % 2 == 1), F.expr("concat('run_', o_orderkey)"))
        .alias("run_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Success"))
        .when(~is_open, F.lit("Failed"))
        .alias("job_status"),
        F.when(~is_open, F.lit("1/1 Validations Passed")).alias("status_msg"),
        F.when(~is_open, F.col("o_orderdate")).alias("execution_start_time"),
        F.when(~is_open, F.col("o_orderdate")).alias("execution_end_time"),
    )


def details(lineitem: DataFrame) -> DataFrame:
    """Check results: passed, failed and without a status."""
    return lineitem.select(
        F.expr("concat('run_', l_orderkey)").alias("run_id"),
        F.col("l_orderkey").alias("job_id"),
        F.col("l_suppkey").alias("config_id"),
        _pick(NAMES, "l_suppkey % 9").alias("expectation_name"),
        _pick(COLUMNS, "l_linenumber % 5").alias("column_name"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "A")
        .alias("expectation_status"),
        (F.col("l_quantity") * 10).cast("bigint").alias("scanned"),
        F.col("l_linenumber").cast("bigint").alias("failure"),
        F.when(F.col("l_linenumber") == 1, F.format_string('["%s"]', "l_linestatus"))
        .alias("details"),
    )


def packed_metrics(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Metrics in their packed text form: three per check result, two per job."""

    def row(run, suite, metric, kwargs, value):
        return F.struct(
            F.concat(F.lit("run_"), run).alias("run_name"),
            F.concat(F.lit("job_"), suite).alias("expectation_suite_identifier"),
            metric.alias("metric_name"),
            kwargs.alias("metric_kwargs_id"),
            F.concat(F.lit('{"value": '), value, F.lit("}")).alias("value"),
        )

    results = details(lineitem)
    kwargs = F.concat(F.lit("column="), F.col("column_name"))
    run = F.col("job_id").cast("string")
    of_checks = [
        row(run, run, F.concat("expectation_name", F.lit(suffix)), kwargs, value.cast("string"))
        for suffix, value in [
            (".result.element_count", F.col("scanned")),
            (".result.unexpected_count", F.col("failure")),
            (".success", F.coalesce(F.col("expectation_status").cast("string"), F.lit("null"))),
        ]
    ]
    order, name = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    of_jobs = [
        row(order, name, F.lit(f"statistics.{key}"), kwargs_id, value.cast("string"))
        for key, kwargs_id, value in [
            ("evaluated_expectations", F.lit(None).cast("string"), F.col("o_orderkey") % 7 + 7),
            ("successful_expectations", F.lit(""), F.col("o_orderkey") % 7),
        ]
    ]
    return results.select(F.inline(F.array(*of_checks))).unionByName(
        orders.select(F.inline(F.array(*of_jobs)))
    )


CHECKS = f"""checks AS (
  SELECT n_nationkey::bigint AS exp_id, {_NAMES_SQL}[n_nationkey % 10 + 1] AS expectation_name
  FROM nation)"""

CONFIG = """config AS (
  SELECT c_custkey AS config_id, c_nationkey::bigint AS exp_id, 'main' AS schema_name,
    'table_' || (c_custkey // 3) AS table_name,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN lower(c_mktsegment) END AS column_name,
    CASE c_custkey % 6
      WHEN 0 THEN '{"value_set":["' || c_mktsegment || '","NONE"]}'
      WHEN 1 THEN '{"value":' || c_nationkey || '}'
      WHEN 2 THEN '{"like_pattern":"%' || c_mktsegment || '"}'
      WHEN 3 THEN '{"substring":"' || c_mktsegment || '","mostly":0.9}'
      WHEN 4 THEN '{"columns":["a","b"],"value":0}'
      ELSE '{"row_condition":"a > 1"}' END AS expectation_parameters,
    CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS flag
  FROM customer)"""

JOBS = """jobs AS (
  SELECT o_orderkey AS job_id, 'job_' || o_custkey AS job_name, 'main' AS schema_name,
    'table_' || (o_custkey // 3) AS table_name,
    CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN NULL ELSE 1 END AS full_table,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'load_month' END AS pipeline_run_id_name,
    CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y-%m') END AS pipeline_run_id,
    CASE WHEN o_orderstatus <> 'O' OR o_orderkey % 2 = 1 THEN 'run_' || o_orderkey END AS run_id,
    CASE o_orderstatus WHEN 'O' THEN NULL WHEN 'F' THEN 'Success' ELSE 'Failed' END AS job_status,
    CASE WHEN o_orderstatus <> 'O' THEN '1/1 Validations Passed' END AS status_msg,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS execution_start_time,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS execution_end_time
  FROM orders)"""

ACTIVE = """active AS (
  SELECT config_id, exp_id, schema_name, table_name, column_name, expectation_parameters,
    expectation_name
  FROM config JOIN checks USING (exp_id) WHERE flag = 1)"""

PLAN = """plan AS (
  SELECT a.*, j.* EXCLUDE (schema_name, table_name)
  FROM active a JOIN jobs j USING (schema_name, table_name)
  WHERE j.job_status IS NULL AND a.expectation_name IS NOT NULL)"""

DETAILS = f"""details AS (
  SELECT 'run_' || l_orderkey AS run_id, l_orderkey AS job_id, l_suppkey AS config_id,
    {_NAMES_SQL}[l_suppkey % 9 + 1] AS expectation_name,
    {_COLUMNS_SQL}[l_linenumber % 5 + 1] AS column_name,
    CASE l_returnflag WHEN 'N' THEN NULL ELSE l_returnflag = 'A' END AS expectation_status,
    (l_quantity * 10)::bigint AS scanned, l_linenumber::bigint AS failure,
    CASE WHEN l_linenumber = 1 THEN '["' || l_linestatus || '"]' END AS details
  FROM lineitem)"""

METRICS = f"""metrics AS (
  SELECT * FROM (
    SELECT run_id, job_id, config_id, expectation_name, column_name, unnest([
      {{'metric': 'element_count', 'value': scanned::varchar}},
      {{'metric': 'unexpected_count', 'value': failure::varchar}},
      {{'metric': 'observed_value',
        'value': CASE WHEN expectation_name <> '{DISTINCT_IN_SET}' THEN details END}},
      {{'metric': 'success', 'value': expectation_status::varchar}}], recursive := true)
    FROM details)
  WHERE value IS NOT NULL)"""

PACKED = """packed AS (
  SELECT run_id AS run_name, 'job_' || job_id AS expectation_suite_identifier,
    'column=' || column_name AS metric_kwargs_id, unnest([
      {'metric_name': expectation_name || '.result.element_count',
       'value': '{"value": ' || scanned || '}'},
      {'metric_name': expectation_name || '.result.unexpected_count',
       'value': '{"value": ' || failure || '}'},
      {'metric_name': expectation_name || '.success',
       'value': '{"value": ' || coalesce(expectation_status::varchar, 'null') || '}'}
    ], recursive := true)
  FROM details
  UNION ALL BY NAME
  SELECT 'run_' || o_orderkey AS run_name, 'job_' || o_custkey AS expectation_suite_identifier,
    NULL AS metric_kwargs_id, 'statistics.evaluated_expectations' AS metric_name,
    '{"value": ' || (o_orderkey % 7 + 7) || '}' AS value
  FROM orders
  UNION ALL BY NAME
  SELECT 'run_' || o_orderkey AS run_name, 'job_' || o_custkey AS expectation_suite_identifier,
    '' AS metric_kwargs_id, 'statistics.successful_expectations' AS metric_name,
    '{"value": ' || (o_orderkey % 7) || '}' AS value
  FROM orders)"""


def with_tables(*tables: str) -> str:
    return "WITH " + ",\n".join(tables) + "\n"
