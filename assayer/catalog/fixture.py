"""The control tables of the flagship run: thirteen configured checks and eight jobs over the test
tables, whole or by slice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assayer.model import (
    CHECKS_SCHEMA,
    CONFIG_SCHEMA,
    CONTAINS,
    DISTINCT_IN_SET,
    IN_SET,
    JOBS_SCHEMA,
    LENGTH,
    LIKE,
    NOT_NULL,
    QUERIED_UNIQUE,
    UNIQUE,
    Control,
)
from assayer.sources.local import local_frame
from assayer.sources.tables import Tables, parquet_tables

CHECKS = [
    (1, NOT_NULL),
    (2, IN_SET),
    (3, DISTINCT_IN_SET),
    (4, UNIQUE),
    (5, LENGTH),
    (6, LIKE),
    (7, CONTAINS),
    (8, QUERIED_UNIQUE),
    (9, "no_such_check"),
]

CONFIG = [
    (101, 1, "documents_labeled", "quality", "{}", 1),
    (102, 2, "orders", "o_orderstatus", '{"value_set":["O","F"]}', 1),
    (103, 3, "events", "event_type", '{"value_set":["click","view"]}', 1),
    (104, 4, "orders", "o_custkey", "{}", 1),
    (105, 5, "part", "p_brand", '{"value":8}', 1),
    (106, 6, "part", "p_name", '{"like_pattern":"%ring"}', 1),
    (107, 7, "documents", "text", '{"substring":"the"}', 1),
    (108, 8, "lineitem", None, '{"columns":["l_orderkey","l_linenumber"],"value":6}', 1),
    (109, 2, "documents", "lang", '{"value_set":["en","de"]}', 1),
    (110, 1, "orders", "o_orderkey", "{}", 1),
    (111, 2, "orders", "o_orderpriority", '{"value_set":["1-URGENT"]}', 0),
    (112, 9, "part", "p_size", "{}", 1),
    (113, 2, "orders", "o_orderstatus", '{"value_set":["O","F","P"]}', 1),
]

JOBS = [
    (1, "orders_job", "orders", 1, None, None, None),
    (2, "part_job", "part", 1, None, None, None),
    (3, "events_job", "events", 1, None, None, None),
    (4, "documents_job", "documents", 0, "source", "src0", None),
    (5, "lineitem_job", "lineitem", 1, None, None, None),
    (6, "labeled_job", "documents_labeled", 1, None, None, None),
    (7, "orders_job", "orders", 1, None, None, "Success"),
    (8, "broken_job", "part", None, None, None, None),
]


def control(
    spark: SparkSession, checks=CHECKS, config=CONFIG, jobs: DataFrame | None = None
) -> Control:
    """Control tables from rows as above; `jobs` replaces the ledger."""
    if jobs is None:
        rows = [
            (i, n, "main", t, full, run_col, run_val, None, status, None, None, None)
            for i, n, t, full, run_col, run_val, status in JOBS
        ]
        jobs = local_frame(spark, rows, JOBS_SCHEMA)
    rows = [(c, e, "main", t, col, p, f) for c, e, t, col, p, f in config]
    return Control(
        local_frame(spark, checks, CHECKS_SCHEMA), local_frame(spark, rows, CONFIG_SCHEMA), jobs
    )


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The test tables, and `documents_labeled`: documents with their labels where they have any."""
    files = parquet_tables(spark, sf_dir)

    def table(schema: str, name: str) -> DataFrame:
        if name == "documents_labeled":
            return files(schema, "documents").join(files(schema, "labels"), "doc_id", "left")
        return files(schema, name)

    return table
