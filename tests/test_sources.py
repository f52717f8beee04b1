import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from assayer import CheckError
from assayer.sources import sinks
from assayer.sources.jdbc import (
    append_once,
    clear_sql,
    cut_predicates,
    jdbc_read_options,
    partition_cuts,
    publish_sql,
    read_jdbc,
    read_jdbc_cut,
    sql_literal,
    write_jdbc,
)
from assayer.sources.tables import catalog_tables, parquet_tables, run_slice


def test_jdbc_options():
    plain = jdbc_read_options("jdbc:x:y", query="SELECT 1", user="u")
    assert plain["dbtable"] == "(SELECT 1) source_query" and plain["user"] == "u"
    assert "numPartitions" not in plain
    split = jdbc_read_options(
        "jdbc:x:y", table="t", partition_column="id", lower_bound=0, upper_bound=9, num_partitions=4
    )
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "4"
    for bad in ({}, {"query": "q", "table": "t"}, {"table": "t", "partition_column": "id"}):
        with pytest.raises(ValueError):
            jdbc_read_options("jdbc:x:y", **bad)


def test_jdbc_errors_raise(spark):
    # No database is started for the tests: reading and writing are only tried without a driver.
    with pytest.raises(Exception, match="driver"):
        read_jdbc(spark, "jdbc:nosuch:db", table="t")
    with pytest.raises(Exception, match="driver"):
        write_jdbc(spark.range(1), "jdbc:nosuch:db", "t", num_partitions=1)


def met_by(spark, sql_type, values, predicates):
    """How many of the predicates each value meets, and the rows of each; no database, Spark reads the conditions."""
    rows = spark.createDataFrame([(v,) for v in values], f"v {sql_type}")
    tests = [F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in predicates]
    rows = rows.select(*tests).collect()
    return [sum(r) for r in rows], [sum(c) for c in zip(*rows)]


@pytest.mark.parametrize("cuts", [[], [0], [-9], [9], [-20, 20], [3, -3, 3, 0], list(range(-9, 10))])
def test_each_row_meets_one_predicate(spark, cuts):
    times, _ = met_by(spark, "bigint", [None, None, *range(-9, 10)], cut_predicates("v", cuts))
    assert set(times) == {1}


def test_predicates_of_other_types(spark):
    day, now = datetime.date(2024, 2, 29), datetime.datetime(2024, 2, 29, 1, 2, 3, 4)
    for sql_type, values, cuts in [
        ("double", [1.5, float("nan"), float("inf"), float("-inf"), None, -2.25], [-2.25, 1e300]),
        ("date", [day, None, datetime.date(1999, 1, 1)], [day]),
        ("timestamp", [now, None, datetime.datetime(2030, 1, 1)], [now]),
        ("string", ["it's", "", None, "z"], ["it's", "b"]),
        ("decimal(9,2)", [Decimal("1.25"), None, Decimal("-3")], [Decimal("1.25")]),
        ("bigint", [1, None], []),
    ]:
        assert set(met_by(spark, sql_type, values, cut_predicates("v", cuts))[0]) == {1}
    assert cut_predicates("v", [3], nullable=False) == ["v < 3", "NOT (v < 3)"]
    for bad in (None, True, b"x"):
        with pytest.raises(ValueError):
            sql_literal(bad)


def test_cuts_follow_a_crowded_column(spark):
    """Ids crowd at one end, where equal widths would leave one partition with nearly all rows; a third are one value."""
    ids = [i**4 for i in range(600)] + [7] * 300 + [None] * 50
    rows = spark.createDataFrame([(i,) for i in ids], "`the id` bigint").repartition(4)
    cuts = partition_cuts(rows, "the id", 8)
    assert cuts == sorted(set(cuts)) and 7 in cuts
    times, parts = met_by(spark, "bigint", ids, cut_predicates("v", cuts))
    assert set(times) == {1} and sum(parts) == len(ids) and parts[-1] == 50
    crowded = max(parts)
    assert crowded <= 300 + 2 * 900 // 8 and sorted(parts)[-2] <= 2 * 900 // 8
    assert partition_cuts(rows, "the id", 1) == [] and partition_cuts(rows.limit(0), "the id", 4) == []
    with pytest.raises(ValueError):
        partition_cuts(rows, "the id", 0)
    with pytest.raises(Exception, match="driver"):
        read_jdbc_cut(spark, "jdbc:nosuch:db", "t", "id", cuts)


def test_rows_are_appended_once(spark):
    """Tasks that write twice, loads that break off and loads that are repeated. No database is started: lists stand for the tables,
    and Spark runs what the statements select."""
    schema = "run_id string, config_id bigint, status boolean"
    rows = [("r1", 1, True), ("r1", 2, None), (None, 2, False), ("r1", None, True)]
    df = spark.createDataFrame(rows, schema)
    details, staged = [("r0", 1, True)], []

    def execute(statement):
        spark.createDataFrame(details, schema).createOrReplaceTempView("details")
        spark.createDataFrame(staged, f"{schema}, load_id string").createOrReplaceTempView("details_staging")
        if statement.startswith("DELETE FROM details_staging WHERE "):
            left = spark.sql(f"SELECT * FROM details_staging WHERE NOT ({statement.split(' WHERE ', 1)[1]})")
            staged[:] = [tuple(r) for r in left.collect()]
        else:
            into, select = statement.split(" SELECT ", 1)
            assert into == "INSERT INTO details (run_id, config_id, status)"
            details.extend(tuple(r) for r in spark.sql(f"SELECT {select}").collect())

    def write(load, url, table, times=1, fails=False):
        assert table == "details_staging"
        staged.extend([tuple(r) for r in load.collect()] * times)
        if fails:
            raise RuntimeError("broken off")

    def load(load_id="it's 1", **options):
        append_once(df, "jdbc:x", "details", ["run_id", "config_id"], load_id, execute, write=write, **options)

    want = sorted([("r0", 1, True), *rows], key=str)
    with pytest.raises(RuntimeError):
        load(fails=True)
    assert details == [("r0", 1, True)] and len(staged) == 4
    for options in ({}, {"times": 3}, {"load_id": "again"}):
        load(**options)
        assert sorted(details, key=str) == want and staged == []
    for keys in ([], ["nothing"]):
        with pytest.raises(ValueError):
            append_once(df, "jdbc:x", "details", keys, "l", execute, write=write)
        with pytest.raises(ValueError):
            publish_sql("t", "s", ["a"], keys, "l")
    with pytest.raises(ValueError):
        append_once(df.withColumnRenamed("status", "load_id"), "jdbc:x", "details", ["run_id"], "l", execute, write=write)
    assert clear_sql("s", "a'b") == "DELETE FROM s WHERE load_id = 'a''b'"


def test_tables(spark, sf):
    assert parquet_tables(spark, sf)("any", "region").count() == 5
    spark.range(3).createOrReplaceGlobalTempView("three")
    assert catalog_tables(spark)("global_temp", "three").count() == 3
    with pytest.raises(PySparkException):
        catalog_tables(spark)("global_temp", "three rows").count()


def test_run_slice(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "`run id` int, v string")
    assert [r["v"] for r in run_slice(df, "run id", "2").collect()] == ["b"]
    assert [r["v"] for r in run_slice(df, "run id", 2).collect()] == ["b"]
    for bad in ("x", None):
        with pytest.raises(CheckError):
            run_slice(df, "run id", bad)
    with pytest.raises(CheckError):
        run_slice(df, "run", "2")


def test_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a/b=c 1"), (2, "a/b=c 1")], "id int, run string")
    sinks.write_partition(one, path, run="a/b=c 1")
    sinks.write_partition(one, path, run="007")
    sinks.write_partition(one.limit(1), path, run="007")
    back = sinks.read_partitions(spark, path, one.schema, "run")
    rows = sorted((r["run"], r["id"]) for r in back.collect())
    assert rows == [("007", 1), ("a/b=c 1", 1), ("a/b=c 1", 2)]
    sinks.write_partition(one.filter("false"), path, run="007")
    assert sinks.read_partitions(spark, path, one.schema, "run").filter("run = '007'").isEmpty()


def test_a_run_is_read_from_its_own_folder(spark, tmp_path):
    """Folders of a thousand other runs are not looked into: what lies there is no Parquet."""
    path, schema = tmp_path / "t", "id int, run_id string, name string"
    for i in range(1_000):
        other = path / f"run_id={i}" / "check_batch=x"
        other.mkdir(parents=True)
        (other / "part.parquet").write_bytes(b"none")
    rows = spark.createDataFrame([(1, "r 1", "a")], schema)
    for batch in ("a/b full", "007"):
        sinks.write_partition(rows, str(path), run_id="r 1", check_batch=batch)
    back = sinks.read_run(spark, str(path), schema, run_id="r 1")
    assert back.columns == ["id", "name", "run_id", "check_batch"] and all("run_id=r%25201/" in f for f in back.inputFiles())
    assert sorted(map(tuple, back.collect())) == [(1, "a", "r 1", "007"), (1, "a", "r 1", "a/b full")]
    none = sinks.read_run(spark, str(path), schema, run_id="not there")
    assert none.columns == back.columns and none.isEmpty()


def test_ledger_snapshots(spark, tmp_path):
    base = str(tmp_path)
    sinks.write_ledger(spark.range(2), base, "r 1")
    first = sinks.read_ledger(spark, base, "r 1")
    sinks.write_ledger(first, base, "r 2", first)
    sinks.write_ledger(first, base, "r 2", first)
    with pytest.raises(ValueError):
        sinks.write_ledger(first, base, "r 1", first)
    for snapshot in ("r 1", "r 2"):
        assert sinks.read_ledger(spark, base, snapshot).count() == 2
