from pyspark.sql import functions as F

from assayer.model import JOBS_SCHEMA
from assayer.plans import control as C
from assayer.plans import details as D


def jobs(spark, *rows):
    return spark.createDataFrame(
        [(i, name, "s", "t", 1, None, None, run, status, msg, None, None) for i, name, run, status, msg in rows],
        JOBS_SCHEMA,
    )


def outcome(spark, *rows):
    df = spark.createDataFrame(list(rows), "job_id bigint, run_id string, job_status string, status_msg string")
    return df.withColumns(
        {"execution_start_time": F.current_timestamp(), "execution_end_time": F.current_timestamp()}
    )


def test_finished_jobs_are_never_rewritten(spark):
    before = jobs(
        spark,
        (1, "j", None, None, None),
        (2, "j", "old", "Success", "1/1 Validations Passed"),
        (3, "k", None, None, "kept"),
        (4, "k", None, None, None),
    )
    after = C.ledger_transition(
        before,
        outcome(spark, (1, "r", "Success", "m"), (2, "r", "Failed", "m"), (3, "r", "Success", "m")),
    )
    assert after.schema.names == before.schema.names
    rows = {r["job_id"]: (r["run_id"], r["job_status"], r["status_msg"]) for r in after.collect()}
    assert rows == {
        1: ("r", "Success", "m"),
        2: ("old", "Success", "1/1 Validations Passed"),
        3: ("r", "Success", "kept"),
        4: (None, None, None),
    }


def test_keep_first(spark):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "w"), ("b", 5, "v"), (None, 1, "u")]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    want = [("a", 1, "y"), ("b", None, "w"), (None, 1, "u")]
    kept = C.keep_first(df, ["k"], ["n"])
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)


def packed(spark):
    check = "expect_column_values_to_be_in_set"
    return spark.createDataFrame(
        [
            ("r1", "orders_job", "statistics.evaluated_expectations", None, '{"value": 3}'),
            ("r1", "orders_job", "statistics.successful_expectations", "", '{"value": 1}'),
            ("r1", "orders_job", f"{check}.result.element_count", "column=status", '{"value": 15000}'),
            ("r1", "orders_job", f"{check}.result.unexpected_count", "column=status", '{"value": 5088}'),
            ("r1", "orders_job", f"{check}.success", "column=status", '{"value": false}'),
        ],
        "run_name string, expectation_suite_identifier string, metric_name string, "
        "metric_kwargs_id string, value string",
    )


def test_packed_metrics(spark):
    rows = [tuple(r)[2:] for r in D.parse_metrics(packed(spark)).collect()]
    check = "expect_column_values_to_be_in_set"
    assert rows == [
        ("statistics", None, "evaluated_expectations", "3"),
        ("statistics", None, "successful_expectations", "1"),
        (check, "status", "element_count", "15000"),
        (check, "status", "unexpected_count", "5088"),
        (check, "status", "success", "false"),
    ]


def test_packed_metrics_of_two_configurations(spark):
    plan = spark.createDataFrame(
        [(1, 7, "expect_column_values_to_be_in_set", "status", "r1", "s", "t")]
        + [(1, 8, "expect_column_values_to_be_in_set", "status", "r1", "s", "t")]
        + [(1, 9, "expect_column_values_to_be_in_set", None, "r1", "s", "t")],
        "job_id bigint, config_id bigint, expectation_name string, column_name string, "
        "run_id string, schema_name string, table_name string",
    )
    wide = D.details_wide(D.join_metrics(plan, packed(spark)))
    rows = {r["config_id"]: (r["scanned"], r["success"], r["failure"], r["expectation_status"]) for r in wide.collect()}
    assert rows == {7: (15000, 9912, 5088, False), 8: (15000, 9912, 5088, False)}


def test_messages_from_packed_metrics(spark):
    open_jobs = jobs(
        spark, (1, "orders_job", "r1", None, None), (2, "orders_job", "r1", None, "done"), (3, "x", "r1", None, None)
    )
    (row,) = D.packed_statistics(packed(spark), open_jobs).collect()
    assert (row["job_id"], row["status_msg"]) == (1, "1/3 Validations Passed")


def test_details_survive_the_long_form(spark):
    details = spark.createDataFrame(
        [
            ("r", 1, 10, "c", "a", True, 5, 0, None),
            ("r", 1, 11, "c", None, False, None, None, "6"),
            ("r", 2, 12, "c", "b", False, 7, 7, None),
        ],
        "run_id string, job_id bigint, config_id bigint, expectation_name string, column_name string, "
        "expectation_status boolean, scanned bigint, failure bigint, details string",
    )
    wide = D.details_wide(D.metrics_long(details)).select(*details.columns)
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, details.collect()))


def test_statistics_without_evaluated_checks(spark):
    details = spark.createDataFrame([("r", 1, None)], "run_id string, job_id bigint, expectation_status boolean")
    (row,) = D.suite_statistics(details).collect()
    assert row["success_percent"] is None and row["status_msg"] == "0/0 Validations Passed"
    assert D.suite_metrics_long(D.suite_statistics(details)).count() == 3
