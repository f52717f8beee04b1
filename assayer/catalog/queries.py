"""The registered queries, each with the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.catalog import derived as G
from assayer.catalog import fixture
from assayer.model import (
    CONTAINS,
    DISTINCT_IN_SET,
    IN_SET,
    LENGTH,
    LIKE,
    NOT_NULL,
    QUERIED_UNIQUE,
    UNIQUE,
    Check,
)
from assayer.operators import keys
from assayer.operators.failed import failed_rows
from assayer.operators.registry import register_query_check, register_row_check
from assayer.operators.scorecard import (
    distinct_values,
    duplicate_group_counts,
    observed_values,
    scorecard,
)
from assayer.plans import control as C
from assayer.plans import details as D
from assayer.plans.runner import run_jobs
from assayer.sources.tables import run_slice

RUN = "run_1"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str, name: str | None = None):
    """Register a query with its SQL, under its function's name unless another is given."""

    def add(build):
        QUERIES[name or build.__name__] = build
        ORACLE[name or build.__name__] = sql
        return build

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fixture.tables(spark, sf_dir)("main", name)


def _scores(batch: DataFrame, *checks: Check, by: str | None = None) -> DataFrame:
    scores = scorecard(batch, checks, by)
    return scores if by else scores.drop("slice")


def _counts(batch: DataFrame, *checks: Check) -> DataFrame:
    """Scores of checks that have no details."""
    return _scores(batch, *checks).drop("details")


# --- scans ---------------------------------------------------------------------------------------


@query("SELECT * FROM part")
def scan_full_table(spark, sf_dir):
    return _table(spark, sf_dir, "part")


@query("SELECT * FROM documents WHERE source = 'src0'")
def scan_run_slice(spark, sf_dir):
    return run_slice(_table(spark, sf_dir, "documents"), "source", "src0")


# --- checks --------------------------------------------------------------------------------------


def _count_sql(config_id: int, table: str, violation: str, condition: str = "TRUE") -> str:
    """SQL of a row-level check without tolerance."""
    return f"""SELECT {config_id}::bigint AS config_id,
      count(*) FILTER (WHERE ({condition}) AND ({violation})) = 0 AS expectation_status,
      count(*) FILTER (WHERE {condition}) AS scanned,
      count(*) FILTER (WHERE {condition})
        - count(*) FILTER (WHERE ({condition}) AND ({violation})) AS success,
      count(*) FILTER (WHERE ({condition}) AND ({violation})) AS failure
    FROM {table}"""


LABELED = "(SELECT * FROM documents LEFT JOIN labels USING (doc_id))"

SET_CHECK = Check(102, IN_SET, "o_orderstatus", {"value_set": ["O", "F"]})
LENGTH_CHECK = Check(105, LENGTH, "p_brand", {"value": 8})
LIKE_CHECK = Check(106, LIKE, "p_name", {"like_pattern": "%ring"})
CONTAINS_CHECK = Check(107, CONTAINS, "text", {"substring": "the"})
NULL_CHECK = Check(101, NOT_NULL, "quality", {})
DISTINCT_CHECK = Check(103, DISTINCT_IN_SET, "event_type", {"value_set": ["click", "view"]})
LANG_CHECK = Check(109, IN_SET, "lang", {"value_set": ["en", "de"]})


@query(_count_sql(102, "orders", "o_orderstatus NOT IN ('O', 'F')"))
def check_in_set(spark, sf_dir):
    return _counts(_table(spark, sf_dir, "orders"), SET_CHECK)


@query(_count_sql(101, LABELED, "quality IS NULL"))
def check_not_null(spark, sf_dir):
    return _counts(_table(spark, sf_dir, "documents_labeled"), NULL_CHECK)


@query(_count_sql(105, "part", "length(p_brand) <> 8"))
def check_length(spark, sf_dir):
    return _counts(_table(spark, sf_dir, "part"), LENGTH_CHECK)


@query(_count_sql(106, "part", "p_name NOT LIKE '%ring'"))
def check_like(spark, sf_dir):
    return _counts(_table(spark, sf_dir, "part"), LIKE_CHECK)


# A backslash in a pattern stands for itself, and escapes only where the check says so.
PATHS = "(SELECT p_type || '\\' || p_name AS path FROM part)"
PATH_CHECKS = [
    Check(131, LIKE, "path", {"like_pattern": "%\\%ring"}),
    Check(133, LIKE, "path", {"like_pattern": "%\\_%"}),
    Check(134, LIKE, "path", {"like_pattern": "%!_%", "escape": "!"}),
]


@query(
    " UNION ALL ".join(
        [
            _count_sql(131, PATHS, "path NOT LIKE '%\\%ring'"),
            _count_sql(133, PATHS, "path NOT LIKE '%\\_%'"),
            _count_sql(134, PATHS, "path NOT LIKE '%!_%' ESCAPE '!'"),
        ]
    )
)
def check_like_backslash(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    paths = part.select(F.concat("p_type", F.lit("\\"), "p_name").alias("path"))
    return _counts(paths, *PATH_CHECKS)


@query(_count_sql(107, "documents", "NOT contains(text, 'the')"))
def check_contains(spark, sf_dir):
    return _counts(_table(spark, sf_dir, "documents"), CONTAINS_CHECK)


@query("""SELECT 103::bigint AS config_id, bool_and(v IN ('click', 'view')) AS expectation_status,
      count(*) AS scanned, count(*) FILTER (WHERE v IN ('click', 'view')) AS success,
      count(*) FILTER (WHERE v NOT IN ('click', 'view')) AS failure,
      count(*) || ' distinct values, ' || count(*) FILTER (WHERE v NOT IN ('click', 'view'))
        || ' outside the set' AS details
    FROM (SELECT DISTINCT event_type AS v FROM events)""")
def check_distinct_in_set(spark, sf_dir):
    return _scores(_table(spark, sf_dir, "events"), DISTINCT_CHECK)


CUSTOMERS = Check(130, DISTINCT_IN_SET, "o_custkey", {"value_set": [1, 2, 3, 4]})


@query("""SELECT DISTINCT NULL::varchar AS slice, 130::bigint AS config_id, o_custkey::varchar AS value,
      o_custkey NOT IN (1, 2, 3, 4) AS outside FROM orders""")
def observed_values_all(spark, sf_dir):
    return observed_values(_table(spark, sf_dir, "orders"), [CUSTOMERS])


@query("""SELECT DISTINCT o_orderpriority AS slice, 130::bigint AS config_id, o_custkey::varchar AS value,
      o_custkey NOT IN (1, 2, 3, 4) AS outside FROM orders""")
def observed_values_by_slice(spark, sf_dir):
    return observed_values(_table(spark, sf_dir, "orders"), [CUSTOMERS], "o_orderpriority")


@query("SELECT DISTINCT source AS slice, lang AS value FROM documents WHERE lang IS NOT NULL")
def distinct_values_by_slice(spark, sf_dir):
    return distinct_values(_table(spark, sf_dir, "documents"), "lang", "source")


def _unique_sql(config_id: int, table: str, key: str) -> str:
    return f"""SELECT {config_id}::bigint AS config_id,
      coalesce(sum(n) FILTER (WHERE n > 1 AND k IS NOT NULL), 0) = 0 AS expectation_status,
      sum(n)::bigint AS scanned,
      (sum(n) - coalesce(sum(n) FILTER (WHERE n > 1 AND k IS NOT NULL), 0))::bigint AS success,
      coalesce(sum(n) FILTER (WHERE n > 1 AND k IS NOT NULL), 0)::bigint AS failure
    FROM (SELECT {key} AS k, count(*) AS n FROM {table} GROUP BY 1)"""


@query(_unique_sql(104, "orders", "o_custkey"))
def check_unique(spark, sf_dir):
    return _counts(_table(spark, sf_dir, "orders"), Check(104, UNIQUE, "o_custkey"))


@query(_unique_sql(204, LABELED, "quality"))
def check_unique_with_nulls(spark, sf_dir):
    return _counts(_table(spark, sf_dir, "documents_labeled"), Check(204, UNIQUE, "quality"))


@query("""SELECT l_orderkey, l_linenumber, count(*) AS group_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_groups(spark, sf_dir):
    lineitem = _table(spark, sf_dir, "lineitem")
    return keys.duplicate_groups(lineitem, ["l_orderkey", "l_linenumber"])


GROUP_PARAMS = {"columns": ["l_orderkey", "l_linenumber"], "value": 6}


@query("""SELECT 108::bigint AS config_id, max(n) FILTER (WHERE n > 1) = 6 AS expectation_status,
      (max(n) FILTER (WHERE n > 1))::varchar AS details, count(*) FILTER (WHERE n > 1) AS groups
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def check_duplicate_groups(spark, sf_dir):
    check = Check(108, QUERIED_UNIQUE, None, GROUP_PARAMS)
    return duplicate_group_counts(_table(spark, sf_dir, "lineitem"), check).select(
        F.lit(check.config_id).cast("bigint").alias("config_id"),
        F.col("met").alias("expectation_status"),
        F.col("observed").cast("string").alias("details"),
        "groups",
    )


@query("""SELECT 208::bigint AS config_id, max(n) = 11785 AS expectation_status, max(n)::varchar AS details
    FROM (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
      HAVING count(*) > 1))""")
def check_query_value(spark, sf_dir):
    sql = """SELECT count(*) FROM (SELECT 1 FROM {active_batch}
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
    check = Check(208, QUERIED_UNIQUE, None, {"query": sql, "value": 11785})
    return _scores(_table(spark, sf_dir, "lineitem"), check).select(
        "config_id", "expectation_status", "details"
    )


@query("""SELECT o_custkey AS slice, 210::bigint AS config_id, count(DISTINCT o_orderstatus) + 1 = 4 AS expectation_status,
      (count(DISTINCT o_orderstatus) + 1)::varchar AS details
    FROM orders GROUP BY o_custkey""")
def check_query_grouped_slices(spark, sf_dir):
    """A query by customer that Spark cannot take apart by slice, so it groups by itself."""
    sql = """SELECT {group}, count(*) FROM (
        SELECT {group}, o_orderstatus FROM {active_batch} GROUP BY {group}, ROLLUP (o_orderstatus))
      GROUP BY {group}"""
    check = Check(210, QUERIED_UNIQUE, None, {"query": sql, "value": 4})
    orders = _table(spark, sf_dir, "orders")
    customers = orders.select(F.col("o_custkey").cast("string").alias("slice")).distinct()
    scores = scorecard(orders, [check], "o_custkey", customers)
    return scores.select("slice", "config_id", "expectation_status", "details")


@query(
    _count_sql(202, "orders", "o_orderstatus NOT IN ('O', 'F')", "o_totalprice > 100000")
    + " UNION ALL "
    + _count_sql(203, "orders", "NOT contains(o_orderpriority, 'LOW')", "o_orderstatus = 'P'")
)
def check_row_condition(spark, sf_dir):
    return _counts(
        _table(spark, sf_dir, "orders"),
        Check(
            202,
            IN_SET,
            "o_orderstatus",
            {"value_set": ["O", "F"], "row_condition": "o_totalprice > 100000"},
        ),
        Check(
            203,
            CONTAINS,
            "o_orderpriority",
            {"substring": "LOW", "row_condition": "o_orderstatus = 'P'"},
        ),
    )


@query("""SELECT c AS config_id, (n - f)::double / n >= m AS expectation_status, n AS scanned,
      n - f AS success, f AS failure
    FROM (
      SELECT 301::bigint AS c, count(*) AS n, count(*) FILTER (WHERE quality IS NULL) AS f, 0.35 AS m
      FROM documents LEFT JOIN labels USING (doc_id)
      UNION ALL
      SELECT 302, count(*), count(*) FILTER (WHERE quality IS NULL), 0.45
      FROM documents LEFT JOIN labels USING (doc_id)
      UNION ALL
      SELECT 303, count(*), count(*) FILTER (WHERE lang NOT IN ('en', 'de')), 0.6
      FROM documents LEFT JOIN labels USING (doc_id))""")
def check_mostly(spark, sf_dir):
    return _counts(
        _table(spark, sf_dir, "documents_labeled"),
        Check(301, NOT_NULL, "quality", {"mostly": 0.35}),
        Check(302, NOT_NULL, "quality", {"mostly": 0.45}),
        Check(303, IN_SET, "lang", {"value_set": ["en", "de"], "mostly": 0.6}),
    )


@query(
    "SELECT *, NULL::varchar AS details FROM ("
    + _count_sql(105, "part", "length(p_brand) <> 8")
    + ") UNION ALL SELECT 112, NULL, NULL, NULL, NULL, 'unknown check'"
)
def unknown_check(spark, sf_dir):
    return _scores(
        _table(spark, sf_dir, "part"), LENGTH_CHECK, Check(112, "no_such_check", "p_size")
    )


# Checks that a user adds.
register_row_check("expect_column_values_to_exceed", lambda col, params: col <= F.lit(params["least"]))
register_query_check(
    "expect_row_count_to_equal",
    "SELECT count(*) AS n FROM {active_batch}",
    lambda observed, params: observed == F.lit(params["value"]),
)


@query(_count_sql(141, "orders", "o_totalprice <= 1000"))
def check_registered_row(spark, sf_dir):
    check = Check(141, "expect_column_values_to_exceed", "o_totalprice", {"least": 1000})
    return _counts(_table(spark, sf_dir, "orders"), check)


@query("""SELECT o_orderpriority AS slice, 142::bigint AS config_id, count(*) = 3000 AS expectation_status,
      count(*)::varchar AS details FROM orders GROUP BY 1""")
def check_registered_query(spark, sf_dir):
    check = Check(142, "expect_row_count_to_equal", None, {"value": 3000})
    scores = _scores(_table(spark, sf_dir, "orders"), check, by="o_orderpriority")
    return scores.select("slice", "config_id", "expectation_status", "details")


LINE_CHECKS = [
    Check(401, IN_SET, "l_returnflag", {"value_set": ["A", "R"]}),
    Check(402, IN_SET, "l_linenumber", {"value_set": [1, 2, 3]}),
    Check(403, LENGTH, "l_linestatus", {"value": 1}),
    Check(404, NOT_NULL, "l_shipdate", {}),
    Check(405, LIKE, "l_returnflag", {"like_pattern": "R%"}),
    Check(406, CONTAINS, "l_linestatus", {"substring": "F"}),
    Check(407, IN_SET, "l_tax", {"value_set": [0.0, 0.02, 0.04]}),
    Check(408, NOT_NULL, "l_orderkey", {}),
]


@query(
    " UNION ALL ".join(
        _count_sql(c, "lineitem", v)
        for c, v in [
            (401, "l_returnflag NOT IN ('A', 'R')"),
            (402, "l_linenumber NOT IN (1, 2, 3)"),
            (403, "length(l_linestatus) <> 1"),
            (404, "l_shipdate IS NULL"),
            (405, "l_returnflag NOT LIKE 'R%'"),
            (406, "NOT contains(l_linestatus, 'F')"),
            (407, "l_tax NOT IN (0.0::double, 0.02::double, 0.04::double)"),
            (408, "l_orderkey IS NULL"),
        ]
    )
)
def scorecard_lineitem(spark, sf_dir):
    return _counts(_table(spark, sf_dir, "lineitem"), *LINE_CHECKS)


# Checks of every kind on one table.
@query(
    "SELECT *, NULL::varchar AS details FROM ("
    + " UNION ALL ".join(
        [
            _count_sql(102, "orders", "o_orderstatus NOT IN ('O', 'F')"),
            _count_sql(110, "orders", "o_orderkey IS NULL"),
            _unique_sql(104, "orders", "o_custkey"),
        ]
    )
    + """)
    UNION ALL SELECT 114, bool_and(v IN ('O', 'F')), count(*), count(*) FILTER (WHERE v IN ('O', 'F')),
      count(*) FILTER (WHERE v NOT IN ('O', 'F')), count(*) || ' distinct values, '
        || count(*) FILTER (WHERE v NOT IN ('O', 'F')) || ' outside the set'
    FROM (SELECT DISTINCT o_orderstatus AS v FROM orders)
    UNION ALL SELECT 115, max(n) IS NULL, NULL, NULL, NULL, coalesce(max(n), 0)::varchar
    FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey, o_custkey HAVING count(*) > 1)""",
    name="scorecard",
)
def scorecard_orders(spark, sf_dir):
    return _scores(
        _table(spark, sf_dir, "orders"),
        SET_CHECK,
        Check(110, NOT_NULL, "o_orderkey"),
        Check(104, UNIQUE, "o_custkey"),
        Check(114, DISTINCT_IN_SET, "o_orderstatus", {"value_set": ["O", "F"]}),
        Check(115, QUERIED_UNIQUE, None, {"columns": ["o_orderkey", "o_custkey"], "value": 0}),
    )


@query("""WITH d AS (SELECT * FROM documents)
    SELECT source AS slice, 109::bigint AS config_id,
      count(*) FILTER (WHERE lang NOT IN ('en', 'de')) = 0 AS expectation_status,
      count(*) AS scanned, count(*) FILTER (WHERE lang IN ('en', 'de')) AS success,
      count(*) FILTER (WHERE lang NOT IN ('en', 'de')) AS failure, NULL::varchar AS details
    FROM d GROUP BY 1
    UNION ALL
    SELECT source, 107, count(*) FILTER (WHERE NOT contains(text, 'the')) = 0, count(*),
      count(*) FILTER (WHERE contains(text, 'the')), count(*) FILTER (WHERE NOT contains(text, 'the')),
      NULL
    FROM d GROUP BY 1
    UNION ALL
    SELECT s, 116, coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0, sum(n)::bigint,
      coalesce(sum(n) FILTER (WHERE n = 1), 0)::bigint, coalesce(sum(n) FILTER (WHERE n > 1), 0)::bigint,
      NULL
    FROM (SELECT source AS s, text AS k, count(*) AS n FROM d GROUP BY 1, 2) GROUP BY 1
    UNION ALL
    SELECT s, 117, bool_and(v IN ('en', 'de')), count(*), count(*) FILTER (WHERE v IN ('en', 'de')),
      count(*) FILTER (WHERE v NOT IN ('en', 'de')), count(*) || ' distinct values, '
        || count(*) FILTER (WHERE v NOT IN ('en', 'de')) || ' outside the set'
    FROM (SELECT DISTINCT source AS s, lang AS v FROM d) GROUP BY 1
    UNION ALL
    SELECT s, 118, coalesce(max(n) FILTER (WHERE n > 1), 0) = 0, NULL, NULL, NULL,
      coalesce(max(n) FILTER (WHERE n > 1), 0)::varchar
    FROM (SELECT source AS s, count(*) AS n FROM d GROUP BY source, lang, text) GROUP BY 1""")
def scorecard_slices(spark, sf_dir):
    return _scores(
        _table(spark, sf_dir, "documents"),
        LANG_CHECK,
        CONTAINS_CHECK,
        Check(116, UNIQUE, "text"),
        Check(117, DISTINCT_IN_SET, "lang", {"value_set": ["en", "de"]}),
        Check(118, QUERIED_UNIQUE, None, {"columns": ["lang", "text"], "value": 0}),
        by="source",
    )


# --- failed rows ---------------------------------------------------------------------------------


def _failed(batch: DataFrame, *checks: Check, **options) -> DataFrame:
    return failed_rows(batch, checks, RUN, **options)


def _failed_sql(table: str, violation: str, check: Check) -> str:
    params = check.parameters.replace("'", "''")
    return f"""SELECT *, '{check.name}' AS expectation_name, '{params}' AS parameters,
      '{RUN}' AS run_id FROM {table} WHERE {violation}"""


@query(_failed_sql("orders", "o_orderstatus NOT IN ('O', 'F')", SET_CHECK))
def failed_rows_in_set(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "orders"), SET_CHECK)


@query(_failed_sql("events", "event_type NOT IN ('click', 'view')", DISTINCT_CHECK))
def failed_rows_distinct_in_set(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "events"), DISTINCT_CHECK)


@query(_failed_sql(LABELED, "quality IS NULL", NULL_CHECK))
def failed_rows_not_null(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "documents_labeled"), NULL_CHECK)


@query(_failed_sql("part", "length(p_brand) <> 8", LENGTH_CHECK))
def failed_rows_length(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "part"), LENGTH_CHECK)


@query(_failed_sql("part", "p_name NOT LIKE '%ring'", LIKE_CHECK))
def failed_rows_like(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "part"), LIKE_CHECK)


@query(_failed_sql("documents", "NOT contains(text, 'the')", CONTAINS_CHECK))
def failed_rows_contains(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "documents"), CONTAINS_CHECK)


@query(_failed_sql("documents", "source = 'src0' AND lang NOT IN ('en', 'de')", LANG_CHECK))
def failed_rows_slice(spark, sf_dir):
    return _failed(run_slice(_table(spark, sf_dir, "documents"), "source", "src0"), LANG_CHECK)


TIED = Check(104, UNIQUE, "o_custkey", {"tie_columns": ["o_orderkey"]})
TEXTS = Check(116, UNIQUE, "text")


@query(
    _failed_sql(
        "orders",
        "o_custkey IS NOT NULL QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1",
        TIED,
    )
)
def failed_rows_unique(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "orders"), TIED)


LOOSELY_TIED = Check(122, UNIQUE, "o_custkey", {"tie_columns": ["o_orderpriority"]})


@query(
    _failed_sql(
        "orders",
        """o_custkey IS NOT NULL QUALIFY row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderpriority, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate) > 1""",
        LOOSELY_TIED,
    )
)
def failed_rows_unique_loose_tie(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "orders"), LOOSELY_TIED)


@query(
    _failed_sql(
        "orders", "o_custkey IS NOT NULL QUALIFY count(*) OVER (PARTITION BY o_custkey) > 1", TIED
    )
)
def failed_rows_unique_all(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "orders"), TIED, unique_mode="all")


@query(
    _failed_sql(
        "documents",
        """text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY text
          ORDER BY doc_id, text, lang, source, n_chars) > 1""",
        TEXTS,
    )
)
def failed_rows_unique_untied(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "documents"), TEXTS)


SLICED_TEXTS = Check(119, UNIQUE, "text", {"tie_columns": ["doc_id"]})


@query(
    _failed_sql(
        "documents",
        """text IS NOT NULL AND source IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY source, text ORDER BY doc_id) > 1""",
        SLICED_TEXTS,
    )
)
def failed_rows_unique_slices(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "documents"), SLICED_TEXTS, by="source")


PART_CHECKS = [
    LENGTH_CHECK,
    LIKE_CHECK,
    Check(120, IN_SET, "p_size", {"value_set": [1, 2, 3, 4, 5]}),
    Check(121, UNIQUE, "p_name", {"tie_columns": ["p_partkey"]}),
]


@query(
    " UNION ALL ".join(
        _failed_sql("part", violation, check)
        for violation, check in zip(
            [
                "length(p_brand) <> 8",
                "p_name NOT LIKE '%ring'",
                "p_size NOT IN (1, 2, 3, 4, 5)",
                "TRUE QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) > 1",
            ],
            PART_CHECKS,
        )
    )
)
def failed_rows_union(spark, sf_dir):
    return _failed(_table(spark, sf_dir, "part"), *PART_CHECKS)


# --- control tables ------------------------------------------------------------------------------


def _checks(spark, sf_dir):
    return G.checks(_table(spark, sf_dir, "nation"))


def _config(spark, sf_dir):
    return G.config(_table(spark, sf_dir, "customer"))


def _jobs(spark, sf_dir):
    return G.jobs(_table(spark, sf_dir, "orders"))


def _active(spark, sf_dir):
    return C.active_checks(_config(spark, sf_dir), _checks(spark, sf_dir))


def _plan(spark, sf_dir):
    return C.job_plan(_active(spark, sf_dir), C.pending_jobs(_jobs(spark, sf_dir)))


def _details(spark, sf_dir):
    return G.details(_table(spark, sf_dir, "lineitem"))


def _packed(spark, sf_dir):
    return G.packed_metrics(_table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders"))


WITH_PLAN = [G.CHECKS, G.CONFIG, G.JOBS, G.ACTIVE, G.PLAN]


@query(G.with_tables(G.JOBS) + "SELECT * FROM jobs WHERE job_status IS NULL")
def pending_jobs(spark, sf_dir):
    return C.pending_jobs(_jobs(spark, sf_dir))


@query(G.with_tables(G.CHECKS, G.CONFIG, G.ACTIVE) + "SELECT * FROM active")
def active_checks(spark, sf_dir):
    return _active(spark, sf_dir)


PLAN_COLUMNS = [
    "job_id",
    "config_id",
    "job_name",
    "schema_name",
    "table_name",
    "column_name",
    "expectation_name",
    "expectation_parameters",
    "full_table",
    "pipeline_run_id_name",
    "pipeline_run_id",
]


@query(G.with_tables(*WITH_PLAN) + f"SELECT {', '.join(PLAN_COLUMNS)} FROM plan")
def job_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select(*PLAN_COLUMNS)


@query(
    G.with_tables(*WITH_PLAN)
    + f"""SELECT {', '.join(PLAN_COLUMNS)} FROM plan
    WHERE column_name IS NOT NULL AND expectation_name IS NOT NULL"""
)
def column_checks(spark, sf_dir):
    return C.column_checks(_plan(spark, sf_dir)).select(*PLAN_COLUMNS)


@query(
    G.with_tables(*WITH_PLAN) + "SELECT DISTINCT job_id, job_name, schema_name, table_name FROM plan"
)
def distinct_jobs(spark, sf_dir):
    return C.distinct_jobs(_plan(spark, sf_dir))


@query(
    G.with_tables(*WITH_PLAN)
    + f"""SELECT {', '.join(PLAN_COLUMNS)} FROM plan QUALIFY row_number() OVER (
      PARTITION BY expectation_name, schema_name, table_name, column_name
      ORDER BY config_id, job_id) = 1"""
)
def dedupe_checks(spark, sf_dir):
    names = ["expectation_name", "schema_name", "table_name", "column_name"]
    plan = _plan(spark, sf_dir).select(*PLAN_COLUMNS)
    return C.keep_first(plan, names, ["config_id", "job_id"])


@query(
    G.with_tables(G.CONFIG)
    + """SELECT config_id, expectation_parameters,
      CASE WHEN json_exists(p, '$.value_set')
        THEN array_to_string(json_extract_string(p, '$.value_set[*]'), ',') END AS value_set,
      json_extract_string(p, '$.value')::bigint AS value,
      json_extract_string(p, '$.like_pattern') AS like_pattern,
      json_extract_string(p, '$.substring') AS substring,
      CASE WHEN json_exists(p, '$.columns')
        THEN array_to_string(json_extract_string(p, '$.columns[*]'), ',') END AS columns,
      json_extract_string(p, '$.mostly')::double AS mostly,
      json_extract_string(p, '$.row_condition') AS row_condition
    FROM (SELECT *, expectation_parameters::json AS p FROM config)"""
)
def parse_params(spark, sf_dir):
    parsed = C.with_params(_config(spark, sf_dir))
    return parsed.select(
        "config_id",
        "expectation_parameters",
        F.array_join("params.value_set", ",").alias("value_set"),
        "params.value",
        "params.like_pattern",
        "params.substring",
        F.array_join("params.columns", ",").alias("columns"),
        "params.mostly",
        "params.row_condition",
    )


@query(
    G.with_tables(G.CHECKS, G.CONFIG, G.ACTIVE)
    + """SELECT 'suite_' || (config_id // 10) AS expectation_suite_name, expectation_name,
      expectation_parameters, schema_name, table_name, count(*) AS entries
    FROM active WHERE expectation_name IS NOT NULL GROUP BY ALL"""
)
def build_suites(spark, sf_dir):
    return C.build_suites(
        _active(spark, sf_dir)
        .filter("expectation_name IS NOT NULL")
        .select(
            F.expr("concat('suite_', config_id div 10)").alias("expectation_suite_name"),
            "expectation_name",
            F.col("expectation_parameters").alias("expectation_code"),
            "schema_name",
            "table_name",
        )
    )


OUTCOMES = """outcomes AS (
  SELECT l_orderkey AS job_id, 'next_' || l_orderkey AS run_id,
    CASE WHEN min(l_linenumber) > 1 THEN 'Failed' ELSE 'Success' END AS job_status,
    (count(*) FILTER (WHERE l_returnflag = 'A')) || '/' ||
      (count(*) FILTER (WHERE l_returnflag <> 'N')) || ' Validations Passed' AS status_msg,
    min(l_shipdate) AS execution_start_time, max(l_shipdate) AS execution_end_time
  FROM lineitem GROUP BY l_orderkey)"""


@query(
    G.with_tables(G.JOBS, OUTCOMES)
    + """SELECT j.* REPLACE (
      CASE WHEN moves THEN o.run_id ELSE j.run_id END AS run_id,
      CASE WHEN moves THEN o.job_status ELSE j.job_status END AS job_status,
      CASE WHEN moves THEN coalesce(j.status_msg, o.status_msg) ELSE j.status_msg END AS status_msg,
      CASE WHEN moves THEN o.execution_start_time ELSE j.execution_start_time END
        AS execution_start_time,
      CASE WHEN moves THEN o.execution_end_time ELSE j.execution_end_time END AS execution_end_time)
    FROM (SELECT *, job_status IS NULL AND job_id IN (SELECT job_id FROM outcomes) AS moves FROM jobs) x
      JOIN jobs j USING (job_id) LEFT JOIN outcomes o USING (job_id)"""
)
def ledger_transition(spark, sf_dir):
    lineitem = _table(spark, sf_dir, "lineitem")
    statistics = D.suite_statistics(_details(spark, sf_dir))
    ended = lineitem.groupBy(F.col("l_orderkey").alias("job_id")).agg(
        F.expr("concat('next_', l_orderkey)").alias("run_id"),
        F.when(F.min("l_linenumber") > 1, "Failed").otherwise("Success").alias("job_status"),
        F.min("l_shipdate").alias("execution_start_time"),
        F.max("l_shipdate").alias("execution_end_time"),
    )
    outcomes = ended.join(statistics.select("job_id", "status_msg"), "job_id")
    return C.ledger_transition(_jobs(spark, sf_dir), outcomes)


# --- metrics and details -------------------------------------------------------------------------


@query(G.with_tables(G.DETAILS, G.METRICS) + "SELECT * FROM metrics")
def metrics_long(spark, sf_dir):
    return D.metrics_long(_details(spark, sf_dir))


@query(G.with_tables(G.DETAILS, G.METRICS) + "SELECT * FROM metrics WHERE run_id = 'run_7'")
def metrics_for_run(spark, sf_dir):
    return D.metrics_for_run(D.metrics_long(_details(spark, sf_dir)), "run_7")


@query(
    G.with_tables(G.DETAILS, G.METRICS)
    + """SELECT run_id, job_id, config_id, expectation_name, column_name,
      (max(value) FILTER (WHERE metric = 'success'))::boolean AS expectation_status,
      max(try_cast(value AS bigint)) FILTER (WHERE metric = 'element_count') AS scanned,
      max(try_cast(value AS bigint)) FILTER (WHERE metric = 'element_count')
        - max(try_cast(value AS bigint)) FILTER (WHERE metric = 'unexpected_count') AS success,
      max(try_cast(value AS bigint)) FILTER (WHERE metric = 'unexpected_count') AS failure,
      CASE WHEN expectation_name = '""" + DISTINCT_IN_SET + """' THEN
        max(try_cast(value AS bigint)) FILTER (WHERE metric = 'element_count') || ' distinct values, '
          || max(try_cast(value AS bigint)) FILTER (WHERE metric = 'unexpected_count') || ' outside the set'
        ELSE max(value) FILTER (WHERE metric = 'observed_value') END AS details
    FROM metrics GROUP BY run_id, job_id, config_id, expectation_name, column_name"""
)
def details_wide(spark, sf_dir):
    return D.details_wide(D.metrics_long(_details(spark, sf_dir)))


@query(
    G.with_tables(*WITH_PLAN, G.DETAILS, G.PACKED)
    + """SELECT p.run_id, p.expectation_name, p.column_name, p.job_id, p.config_id, p.schema_name,
      p.table_name, split_part(metric_name, '.', -1) AS metric,
      json_extract_string(value, '$.value') AS value
    FROM plan p JOIN packed m ON p.run_id = m.run_name
      AND p.expectation_name = split_part(metric_name, '.', 1)
      AND p.column_name = split_part(metric_kwargs_id, '=', 2)"""
)
def metrics_parse_join(spark, sf_dir):
    return D.join_metrics(_plan(spark, sf_dir), _packed(spark, sf_dir))


@query(
    G.with_tables(G.DETAILS, G.PACKED)
    + """SELECT run_name AS run_id, expectation_suite_identifier AS suite,
      split_part(metric_name, '.', 1) AS expectation_name,
      CASE WHEN contains(metric_kwargs_id, '=') THEN split_part(metric_kwargs_id, '=', 2) END
        AS column_name,
      split_part(metric_name, '.', -1) AS metric, json_extract_string(value, '$.value') AS value
    FROM packed"""
)
def metrics_parsed(spark, sf_dir):
    return D.parse_metrics(_packed(spark, sf_dir))


@query(
    G.with_tables(G.DETAILS)
    + """SELECT run_id, job_id, n AS evaluated_expectations, ok AS successful_expectations,
      n - ok AS unsuccessful_expectations,
      CASE WHEN n > 0 THEN 100.0::double * ok / n END AS success_percent,
      ok || '/' || n || ' Validations Passed' AS status_msg
    FROM (SELECT run_id, job_id, count(expectation_status) AS n,
      count(*) FILTER (WHERE expectation_status) AS ok FROM details GROUP BY 1, 2)"""
)
def suite_statistics(spark, sf_dir):
    return D.suite_statistics(_details(spark, sf_dir))


@query(
    G.with_tables(G.JOBS, G.DETAILS, G.PACKED)
    + """, counted AS (
      SELECT run_name, expectation_suite_identifier AS suite,
        max(json_extract_string(value, '$.value')) FILTER (
          WHERE metric_name = 'statistics.evaluated_expectations') AS n,
        max(json_extract_string(value, '$.value')) FILTER (
          WHERE metric_name = 'statistics.successful_expectations') AS ok
      FROM packed WHERE metric_name LIKE 'statistics.%' GROUP BY 1, 2)
    SELECT run_id, job_id, job_name, n::bigint AS evaluated_expectations,
      ok::bigint AS successful_expectations, ok || '/' || n || ' Validations Passed' AS status_msg
    FROM counted JOIN (SELECT job_id, job_name, run_id FROM jobs WHERE status_msg IS NULL)
      ON run_name = run_id AND suite = job_name"""
)
def suite_messages(spark, sf_dir):
    return D.packed_statistics(_packed(spark, sf_dir), _jobs(spark, sf_dir))


@query(
    G.with_tables(G.CHECKS, G.CONFIG, G.JOBS, G.DETAILS)
    + """SELECT d.job_id, d.config_id, d.expectation_status, c.exp_id, c.schema_name, c.table_name,
      c.column_name, c.expectation_parameters, k.expectation_name, j.job_name, j.run_id,
      j.pipeline_run_id_name, j.pipeline_run_id
    FROM details d JOIN config c ON d.config_id = c.config_id JOIN checks k ON c.exp_id = k.exp_id
      JOIN jobs j ON d.job_id = j.job_id
    WHERE d.expectation_status = FALSE"""
)
def failed_checks(spark, sf_dir):
    return D.failed_checks(
        _details(spark, sf_dir), _config(spark, sf_dir), _checks(spark, sf_dir), _jobs(spark, sf_dir)
    )


# --- the whole run -------------------------------------------------------------------------------


def _run(spark, sf_dir):
    return run_jobs(spark, fixture.control(spark), fixture.tables(spark, sf_dir), RUN)


def _result_sql(job_id: int, name: str, table: str, column: str, sql: str) -> str:
    return f"""SELECT '{RUN}' AS run_id, {job_id}::bigint AS job_id, '{name}' AS expectation_name,
      'main' AS schema_name, '{table}' AS table_name, {column} AS column_name, config_id,
      expectation_status, scanned, success, failure, details
    FROM ({sql})"""


def _no_details(sql: str) -> str:
    return f"SELECT *, NULL::varchar AS details FROM ({sql})"


SRC0 = "(SELECT * FROM documents WHERE source = 'src0')"

RESULTS = [
    (1, IN_SET, "orders", "'o_orderstatus'", _no_details(ORACLE["check_in_set"])),
    (1, UNIQUE, "orders", "'o_custkey'", _no_details(ORACLE["check_unique"])),
    (
        1,
        NOT_NULL,
        "orders",
        "'o_orderkey'",
        _no_details(_count_sql(110, "orders", "o_orderkey IS NULL")),
    ),
    (
        1,
        IN_SET,
        "orders",
        "'o_orderstatus'",
        _no_details(_count_sql(113, "orders", "o_orderstatus NOT IN ('O', 'F', 'P')")),
    ),
    (2, LENGTH, "part", "'p_brand'", _no_details(ORACLE["check_length"])),
    (2, LIKE, "part", "'p_name'", _no_details(ORACLE["check_like"])),
    (
        2,
        "no_such_check",
        "part",
        "'p_size'",
        """SELECT 112::bigint AS config_id, NULL::boolean AS expectation_status,
          NULL::bigint AS scanned, NULL::bigint AS success, NULL::bigint AS failure,
          'unknown check' AS details""",
    ),
    (3, DISTINCT_IN_SET, "events", "'event_type'", ORACLE["check_distinct_in_set"]),
    (
        4,
        CONTAINS,
        "documents",
        "'text'",
        _no_details(_count_sql(107, SRC0, "NOT contains(text, 'the')")),
    ),
    (
        4,
        IN_SET,
        "documents",
        "'lang'",
        _no_details(_count_sql(109, SRC0, "lang NOT IN ('en', 'de')")),
    ),
    (
        5,
        QUERIED_UNIQUE,
        "lineitem",
        "NULL::varchar",
        """SELECT 108::bigint AS config_id, max(n) = 6 AS expectation_status, NULL::bigint AS scanned,
          NULL::bigint AS success, NULL::bigint AS failure, max(n)::varchar AS details
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    ),
    (6, NOT_NULL, "documents_labeled", "'quality'", _no_details(ORACLE["check_not_null"])),
]

RESULTS_SQL = " UNION ALL ".join(_result_sql(*r) for r in RESULTS)


@query(RESULTS_SQL)
def run_scorecard(spark, sf_dir):
    return _run(spark, sf_dir).details


@query(
    f"""WITH results AS ({RESULTS_SQL}), counted AS (
      SELECT job_id, count(expectation_status) AS n, count(*) FILTER (WHERE expectation_status) AS ok
      FROM results GROUP BY 1)
    SELECT job_id, '{RUN}' AS run_id, 'Success' AS job_status,
      ok || '/' || n || ' Validations Passed' AS status_msg
    FROM counted
    UNION ALL SELECT 7, NULL, 'Success', NULL
    UNION ALL SELECT 8, '{RUN}', 'Failed', 'full_table must be 0 or 1, not None'"""
)
def run_ledger(spark, sf_dir):
    return _run(spark, sf_dir).ledger.select("job_id", "run_id", "job_status", "status_msg")


INVALID_CONFIG = [
    (521, 2, "orders", "no_such_column", '{"value_set":["O"]}', 1),
    (522, 1, "orders", "o_orderkey", "{}", 1),
    (523, 6, "orders", "o_orderpriority", '{"like_pattern":"x!y","escape":"!"}', 1),
]


@query(f"""SELECT 1::bigint AS job_id, '{RUN}' AS run_id, 'Failed' AS job_status,
      (count(*) FILTER (WHERE o_orderkey IS NULL) = 0)::int
        || '/1 Validations Passed; invalid checks: 521, 523' AS status_msg FROM orders
    UNION ALL SELECT i, NULL, CASE WHEN i = 7 THEN 'Success' END, NULL FROM range(2, 9) t(i)""")
def run_invalid_checks(spark, sf_dir):
    control = fixture.control(spark, fixture.CHECKS, INVALID_CONFIG)
    results = run_jobs(spark, control, fixture.tables(spark, sf_dir), RUN)
    return results.ledger.select("job_id", "run_id", "job_status", "status_msg")


@query("""SELECT 'run_1' AS run_id, 3::bigint AS job_id, 103::bigint AS config_id,
      '""" + DISTINCT_IN_SET + """' AS expectation_name, 'event_type' AS column_name, '' AS slice,
      v AS value, v NOT IN ('click', 'view') AS outside
    FROM (SELECT DISTINCT event_type AS v FROM events)""")
def run_observed_values(spark, sf_dir):
    return _run(spark, sf_dir).observed


ORDERS_UNIQUE = Check(104, UNIQUE, "o_custkey", {}, "{}")
ORDERS_SET = Check(102, IN_SET, "o_orderstatus", {}, '{"value_set":["O","F"]}')


@query(
    _failed_sql("orders", "o_orderstatus NOT IN ('O', 'F')", ORDERS_SET)
    + " UNION ALL "
    + _failed_sql(
        "orders",
        """o_custkey IS NOT NULL QUALIFY row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
            o_orderpriority) > 1""",
        ORDERS_UNIQUE,
    )
)
def run_failed_rows_orders(spark, sf_dir):
    return _run(spark, sf_dir).failed["main", "orders", "full"]


# Every unit of the run with violating rows, and the columns that tell its table's rows apart.
FAILED_UNITS = {
    ("orders", "full"): "o_orderkey",
    ("part", "full"): "p_partkey",
    ("events", "full"): "event_id",
    ("documents", "slices of source"): "doc_id",
    ("documents_labeled", "full"): "doc_id",
}


def _violating_keys(table: str, unit: str, key: str, check: str, source: str, where: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{unit}' AS unit, {key}::varchar AS row_key,
      '{check}' AS expectation_name, '{RUN}' AS run_id FROM {source} WHERE {where}"""


@query(
    " UNION ALL ".join(
        _violating_keys(table, unit, FAILED_UNITS[table, unit], check, source, where)
        for table, unit, check, source, where in [
            ("orders", "full", IN_SET, "orders", "o_orderstatus NOT IN ('O', 'F')"),
            (
                "orders",
                "full",
                UNIQUE,
                "orders",
                """o_custkey IS NOT NULL QUALIFY row_number() OVER (PARTITION BY o_custkey
                  ORDER BY o_orderkey) > 1""",
            ),
            ("part", "full", LENGTH, "part", "length(p_brand) <> 8"),
            ("part", "full", LIKE, "part", "p_name NOT LIKE '%ring'"),
            ("events", "full", DISTINCT_IN_SET, "events", "event_type NOT IN ('click', 'view')"),
            (
                "documents",
                "slices of source",
                CONTAINS,
                "documents",
                "source = 'src0' AND NOT contains(text, 'the')",
            ),
            (
                "documents",
                "slices of source",
                IN_SET,
                "documents",
                "source = 'src0' AND lang NOT IN ('en', 'de')",
            ),
            ("documents_labeled", "full", NOT_NULL, LABELED, "quality IS NULL"),
        ]
    )
)
def run_failed_rows(spark, sf_dir):
    parts = []
    for (_, table, unit), rows in _run(spark, sf_dir).failed.items():
        key = FAILED_UNITS.get((table, unit))
        if key is None:  # of checks that have no violating rows
            parts.append(rows.select(*[F.lit(None).cast("string").alias(c) for c in FAILED_COLUMNS]))
            continue
        parts.append(
            rows.select(
                F.lit(table).alias("table_name"),
                F.lit(unit).alias("unit"),
                F.col(key).cast("string").alias("row_key"),
                "expectation_name",
                "run_id",
            )
        )
    return reduce(DataFrame.unionByName, parts)


FAILED_COLUMNS = ["table_name", "unit", "row_key", "expectation_name", "run_id"]


SLICE_CONFIG = [
    (501, 2, "documents", "lang", '{"value_set":["en","de"]}', 1),
    (502, 7, "documents", "text", '{"substring":"the","mostly":0.5}', 1),
    (503, 4, "documents", "text", "{}", 1),
    (504, 3, "documents", "lang", '{"value_set":["en","de","fr"]}', 1),
    (505, 8, "documents", None, '{"columns":["lang","text"],"value":0}', 1),
]


def _slice_jobs(documents: DataFrame) -> DataFrame:
    """A job per source of the documents."""
    job = documents.groupBy("source").agg(F.min("doc_id").alias("job_id"))
    none = [
        F.lit(None).cast(t).alias(n)
        for n, t in [
            ("run_id", "string"),
            ("job_status", "string"),
            ("status_msg", "string"),
            ("execution_start_time", "timestamp"),
            ("execution_end_time", "timestamp"),
        ]
    ]
    return job.select(
        "job_id",
        F.concat(F.lit("load of "), "source").alias("job_name"),
        F.lit("main").alias("schema_name"),
        F.lit("documents").alias("table_name"),
        F.lit(0).alias("full_table"),
        F.lit("source").alias("pipeline_run_id_name"),
        F.col("source").alias("pipeline_run_id"),
        *none,
    )


@query(f"""WITH jobs AS (SELECT min(doc_id) AS job_id, source FROM documents GROUP BY source),
    scores AS (
      SELECT source, 501::bigint AS config_id, '{IN_SET}' AS expectation_name, 'lang' AS column_name,
        bool_and(lang IN ('en', 'de')) AS expectation_status, count(*) AS scanned,
        count(*) FILTER (WHERE lang NOT IN ('en', 'de')) AS failure, NULL::varchar AS details
      FROM documents GROUP BY source
      UNION ALL
      SELECT source, 502, '{CONTAINS}', 'text',
        count(*) FILTER (WHERE contains(text, 'the'))::double / count(*) >= 0.5, count(*),
        count(*) FILTER (WHERE NOT contains(text, 'the')), NULL
      FROM documents GROUP BY source
      UNION ALL
      SELECT source, 503, '{UNIQUE}', 'text', bool_and(n = 1), sum(n)::bigint,
        coalesce(sum(n) FILTER (WHERE n > 1), 0)::bigint, NULL
      FROM (SELECT source, text, count(*) AS n FROM documents GROUP BY ALL) GROUP BY source
      UNION ALL
      SELECT source, 504, '{DISTINCT_IN_SET}', 'lang', bool_and(lang IN ('en', 'de', 'fr')), count(*),
        count(*) FILTER (WHERE lang NOT IN ('en', 'de', 'fr')), count(*) || ' distinct values, '
          || count(*) FILTER (WHERE lang NOT IN ('en', 'de', 'fr')) || ' outside the set'
      FROM (SELECT DISTINCT source, lang FROM documents) GROUP BY source
      UNION ALL
      SELECT source, 505, '{QUERIED_UNIQUE}', NULL, max(n) = 1, NULL, NULL,
        (CASE WHEN max(n) > 1 THEN max(n) ELSE 0 END)::varchar
      FROM (SELECT source, count(*) AS n FROM documents GROUP BY source, lang, text) GROUP BY source)
    SELECT '{RUN}' AS run_id, job_id, expectation_name, 'main' AS schema_name,
      'documents' AS table_name, column_name, config_id, expectation_status, scanned,
      scanned - failure AS success, failure, details
    FROM jobs JOIN scores USING (source)""")
def run_slices(spark, sf_dir):
    jobs = _slice_jobs(_table(spark, sf_dir, "documents"))
    control = fixture.control(spark, fixture.CHECKS, SLICE_CONFIG, jobs)
    return run_jobs(spark, control, fixture.tables(spark, sf_dir), RUN).details


CUSTOMER_CONFIG = [
    (511, 2, "orders", "o_orderstatus", '{"value_set":["O","F"]}', 1),
    (
        512,
        8,
        "orders",
        None,
        """{"query":"SELECT count(*) FROM {active_batch} WHERE o_totalprice > 200000","value":3}""",
        1,
    ),
]


@query(f"""SELECT '{RUN}' AS run_id, o_custkey AS job_id, '{IN_SET}' AS expectation_name,
      'main' AS schema_name, 'orders' AS table_name, 'o_orderstatus' AS column_name,
      511::bigint AS config_id, bool_and(o_orderstatus IN ('O', 'F')) AS expectation_status,
      count(*) AS scanned, count(*) FILTER (WHERE o_orderstatus IN ('O', 'F')) AS success,
      count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F')) AS failure, NULL::varchar AS details
    FROM orders GROUP BY o_custkey
    UNION ALL
    SELECT '{RUN}', o_custkey, '{QUERIED_UNIQUE}', 'main', 'orders', NULL, 512,
      count(*) FILTER (WHERE o_totalprice > 200000) = 3, NULL, NULL, NULL,
      (count(*) FILTER (WHERE o_totalprice > 200000))::varchar
    FROM orders GROUP BY o_custkey""")
def run_many_slices(spark, sf_dir):
    """A job per customer: more slices than the driver looks at."""
    orders = _table(spark, sf_dir, "orders")
    customers = orders.groupBy(F.col("o_custkey").cast("string").alias("source")).agg(
        F.min("o_custkey").alias("doc_id"),
        # not as literals, which Spark would take out of the joins
        F.max(F.lit("main")).alias("schema_name"),
        F.max(F.lit("orders")).alias("table_name"),
    )
    names = customers.select(F.col("doc_id").alias("job_id"), "schema_name", "table_name")
    jobs = _slice_jobs(customers).drop("schema_name", "table_name").join(names, "job_id")
    jobs = jobs.withColumn("pipeline_run_id_name", F.lit("o_custkey"))
    control = fixture.control(spark, fixture.CHECKS, CUSTOMER_CONFIG, jobs)
    return run_jobs(spark, control, fixture.tables(spark, sf_dir), RUN).details


@query(
    G.with_tables(G.DETAILS)
    + """SELECT * FROM (SELECT run_id, job_id, unnest([
        {'metric': 'evaluated_expectations', 'value': n::varchar},
        {'metric': 'successful_expectations', 'value': ok::varchar},
        {'metric': 'unsuccessful_expectations', 'value': (n - ok)::varchar},
        {'metric': 'success_percent',
         'value': CASE WHEN n > 0 THEN (100.0::double * ok / n)::decimal(9, 4)::varchar END}],
      recursive := true)
    FROM (SELECT run_id, job_id, count(expectation_status) AS n,
      count(*) FILTER (WHERE expectation_status) AS ok FROM details GROUP BY 1, 2))
    WHERE value IS NOT NULL"""
)
def suite_metrics_long(spark, sf_dir):
    return D.suite_metrics_long(D.suite_statistics(_details(spark, sf_dir)))
