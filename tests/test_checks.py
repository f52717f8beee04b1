import datetime
import decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from assayer import Check, CheckError, register_query_check, register_row_check, scorecard
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
)
from assayer.operators import registry
from assayer.operators.keys import duplicate_groups
from assayer.operators.scorecard import observed_values


def score(df, name, column=None, by=None, slices=None, **params):
    rows = scorecard(df, [Check(1, name, column, params)], by, slices).collect()
    return {r["slice"]: r for r in rows} if by else rows[0]


def numbers(row):
    return row["scanned"], row["failure"], row["expectation_status"]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([("x",), (None,)], "v string")


# The documented examples of the two custom checks, less the one that spells a person's name.
HIT = ["prafool", "praffy", "prafu", "prafio", "praffle"]
MISS = ["hello", "jason", "mike", "tanya", "jamie", "jess"]


def test_substring_examples(spark):
    hit = spark.createDataFrame([(v,) for v in HIT], "hit string")
    df = spark.createDataFrame([(v,) for v in MISS], "miss string")
    assert numbers(score(hit, CONTAINS, "hit", substring="praf")) == (5, 0, True)
    assert numbers(score(df, CONTAINS, "miss", substring="praf")) == (6, 6, False)
    assert numbers(score(hit, CONTAINS_PRAF, "hit")) == (5, 0, True)
    assert numbers(score(df, CONTAINS_PRAF, "miss")) == (6, 6, False)


def test_duplicate_group_examples(spark):
    rows = [("Ann", "SFO"), ("Jason", "Moraga"), ("Ann", "SFO"), ("ann", "SFO")]
    df = spark.createDataFrame(rows, "NAME string, CITY string")
    columns = ["NAME", "CITY"]
    assert score(df, QUERIED_UNIQUE, columns=columns, value=5)["expectation_status"] is False
    two = score(df, QUERIED_UNIQUE, columns=columns, value=2)
    assert two["expectation_status"] is True and two["details"] == "2"
    sql = "SELECT COUNT(*) FROM {} GROUP BY NAME, CITY HAVING COUNT(*) > 1"
    given = score(df, QUERIED_UNIQUE, query=sql.format("{active_batch}"), value=2)
    assert given["expectation_status"] is True and given["details"] == "2"
    df.createOrReplaceTempView("named_batch")
    named = score(df, QUERIED_UNIQUE, query=sql.format("named_batch"), value=2)
    assert named["expectation_status"] is True


@pytest.mark.parametrize("value", [None, -1, 1.5, "2", True])
def test_group_value_is_refused(spark, value):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(CheckError):
        score(df, QUERIED_UNIQUE, columns=["a"], value=value)
    with pytest.raises(CheckError):
        score(df, QUERIED_UNIQUE, query="SELECT 1 FROM {active_batch}", value=value)


def test_no_duplicate_group(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    row = score(df, QUERIED_UNIQUE, columns=["a"], value=0)
    assert row["expectation_status"] is True and row["details"] == "0"
    assert duplicate_groups(df, ["a"]).isEmpty()


def test_query_without_rows_is_no_success(spark):
    df = spark.createDataFrame([(1,)], "a int")
    row = score(df, QUERIED_UNIQUE, query="SELECT a FROM {active_batch} WHERE a > 1", value=0)
    assert row["expectation_status"] is False and row["details"] is None


@pytest.mark.parametrize(
    "name, params",
    [
        (IN_SET, {"value_set": ["x"]}),
        (LIKE, {"like_pattern": "x%"}),
        (LENGTH, {"value": 1}),
        (CONTAINS, {"substring": "x"}),
    ],
)
def test_null_is_no_violation(texts, name, params):
    assert numbers(score(texts, name, "v", **params)) == (2, 0, True)


def test_null_is_the_violation(texts):
    assert numbers(score(texts, NOT_NULL, "v")) == (2, 1, False)


def test_null_in_value_set(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert numbers(score(df, IN_SET, "v", value_set=[1, None])) == (3, 2, False)


def test_value_sets(spark):
    df = spark.createDataFrame([("a",), ("b",), ("it's",)], "v string")
    assert score(df, IN_SET, "v", value_set=["a"])["failure"] == 2
    assert score(df, IN_SET, "v", value_set=["it's", "a", "b"])["failure"] == 0
    assert score(df, LIKE, "v", like_pattern="it's")["failure"] == 2
    assert score(df, CONTAINS, "v", substring="'")["failure"] == 2
    for bad in ([], [None], "a", [["a"]]):
        with pytest.raises(CheckError):
            score(df, IN_SET, "v", value_set=bad)


def test_value_set_is_compared_in_the_columns_type(spark):
    df = spark.createDataFrame(
        [(1, decimal.Decimal("1.50"), datetime.date(2024, 1, 2), True, 0.1)],
        "i bigint, d decimal(10,2), t date, b boolean, f double",
    )
    assert score(df, IN_SET, "i", value_set=["1"])["failure"] == 0
    assert score(df, IN_SET, "d", value_set=[1.5])["failure"] == 0
    assert score(df, IN_SET, "t", value_set=["2024-01-02"])["failure"] == 0
    assert score(df, IN_SET, "b", value_set=[True])["failure"] == 0
    assert score(df, IN_SET, "f", value_set=[0.1])["failure"] == 0
    for column in "id":
        with pytest.raises(CheckError):
            score(df, IN_SET, column, value_set=[1, "x"])


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_long_value_set_is_joined(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(registry, "INLINE_VALUES", 3)
    monkeypatch.setattr(registry, "BROADCAST_BYTES", broadcast_bytes)
    df = spark.createDataFrame([(i % 10, "k") for i in range(100)] + [(None, "k")], "v int, g string")
    # "1" and 1 are one value: the join must not count a row twice.
    values = ["1", 1, "01", 2, 3, 4, 5]
    assert numbers(score(df, IN_SET, "v", value_set=values)) == (101, 50, False)
    assert numbers(score(df, IN_SET, "v", by="g", value_set=values)["k"]) == (101, 50, False)
    distinct = score(df, DISTINCT_IN_SET, "v", value_set=values)
    assert numbers(distinct) == (10, 5, False)


def test_distinct_values(spark):
    rows = [("a", 3), ("a", 1), ("a", 3), ("b", 2), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v int")
    row = score(df, DISTINCT_IN_SET, "v", value_set=[1, 2])
    assert numbers(row) == (3, 1, False) and row["details"] == "3 distinct values, 1 outside the set"
    sliced = score(df, DISTINCT_IN_SET, "v", by="g", value_set=[1, 2])
    assert numbers(sliced["a"]) == (2, 1, False) and sliced["a"]["details"].startswith("2 distinct")
    assert numbers(sliced["b"]) == (1, 0, True) and sliced["b"]["details"].startswith("1 distinct")
    checks = [Check(1, DISTINCT_IN_SET, "v", {"value_set": [1, 2]}), Check(2, NOT_NULL, "v")]
    seen = observed_values(df, checks, "g").collect()
    assert {tuple(r) for r in seen} == {("a", 1, "1", False), ("a", 1, "3", True), ("b", 1, "2", False)}
    assert {tuple(r) for r in observed_values(df, checks).collect()} == {
        (None, 1, "1", False),
        (None, 1, "2", False),
        (None, 1, "3", True),
    }
    assert observed_values(df, checks[1:]).collect() == []


def test_all_distinct_values_are_observed(spark):
    df = spark.range(2_500).withColumn("v", F.col("id"))
    check = Check(1, DISTINCT_IN_SET, "v", {"value_set": [7]})
    rows = observed_values(df, [check]).collect()
    assert len(rows) == 2_500 and sum(r["outside"] for r in rows) == 2_499


def test_backslashes_and_escapes_in_patterns(spark):
    df = spark.createDataFrame([("C:\\temp1",), ("50%",), ("50\\%",), ("5_0",), ("5x0",)], "v string")

    def failures(**params):
        return score(df, LIKE, "v", **params)["failure"]

    assert failures(like_pattern="C:\\temp%") == 4
    assert failures(like_pattern="50\\%") == 4  # the text with the backslash
    assert failures(like_pattern="50\\%", escape="\\") == 4  # the one without
    assert failures(like_pattern="c:\\TEMP%", ignore_case=True) == 4
    assert failures(like_pattern="5!_0", escape="!") == 4 and failures(like_pattern="5_0") == 3
    for bad in ("ab", "%", 3, ""):
        with pytest.raises(CheckError):
            score(df, LIKE, "v", like_pattern="x", escape=bad)
    with pytest.raises(CheckError):
        score(df, LIKE, "v", like_pattern="a!b", escape="!")


def test_query_with_two_columns_of_one_name_and_a_text(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "v string, n int")
    twice = "SELECT max(n) AS x, min(n) AS x FROM {active_batch}"
    assert score(df, QUERIED_UNIQUE, query=twice, value=2)["expectation_status"] is True
    text = "SELECT max(v) FROM {active_batch}"
    row = score(df, QUERIED_UNIQUE, query=text, value=2)
    assert row["expectation_status"] is False and row["details"] == "b"


def test_query_on_slices_is_one_scan(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(70)], "g int, n int")
    queries = {
        "SELECT count(*) FROM {active_batch} WHERE n > 60": {g: str(sum(i % 7 == g for i in range(61, 70))) for g in range(7)},
        "SELECT count(*) FROM (SELECT n % 2 FROM {active_batch} GROUP BY 1 HAVING count(*) > 4)": dict.fromkeys(range(7), "2"),
        "SELECT max(n) FROM {active_batch}": {g: str(63 + g) for g in range(7)},
    }
    for query, want in queries.items():
        slices = [str(g) for g in range(9)]
        scores = scorecard(df, [Check(1, QUERIED_UNIQUE, None, {"query": query, "value": 2})], "g", slices)
        got = {r["slice"]: r["details"] for r in scores.collect()}
        assert {g: got[g] for g in range(7)} == want and got.keys() == set(range(9))
        plan = scores._jdf.queryExecution().optimizedPlan().toString()
        few = scorecard(df, [Check(1, QUERIED_UNIQUE, None, {"query": query, "value": 2})], "g", ["1", "2"])
        other = few._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") == other.count("LogicalRDD") <= 2


ROLLED = "SELECT {0}count(*) FROM (SELECT {0}n % 3 FROM {{active_batch}} GROUP BY {0}ROLLUP (n % 3)){1}"


@pytest.mark.parametrize("slices", [["1"], [str(g) for g in range(600)]])
def test_query_on_slices_groups_by_itself_or_is_refused(spark, slices):
    """Alike for any number of slices: SQL that Spark cannot take apart by slice needs to name its group."""
    df = spark.createDataFrame([(i % 600, i) for i in range(3_000)], "g int, n int")
    check = Check(1, QUERIED_UNIQUE, None, {"query": ROLLED.format("", ""), "value": 3})
    with pytest.raises(CheckError):
        scorecard(df, [check], "g", slices)
    sql = ROLLED.format("{group}, ", " GROUP BY {group}")
    check = Check(1, QUERIED_UNIQUE, None, {"query": sql, "value": 2})
    scores = scorecard(df, [check], "g", slices)
    want = {int(s): 1 + len({n % 3 for n in range(int(s), 3_000, 600)}) for s in slices}
    got = {r["slice"]: (r["details"], r["expectation_status"]) for r in scores.collect()}
    assert got == {s: (str(n), n == 2) for s, n in want.items()}
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 2  # the rows and the slices


def test_grouped_query_on_a_table_and_on_slices_without_rows(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "g int, __group int")
    sql = "SELECT {group}, count(*) FROM {active_batch} GROUP BY {group}"
    row = score(df, QUERIED_UNIQUE, query=sql, value=3)
    assert row["expectation_status"] is True and row["details"] == "3"
    by = {r["slice"]: r["details"] for r in scorecard(df, [Check(1, QUERIED_UNIQUE, None, {"query": sql, "value": 2})], "g", ["1", "2", "9"]).collect()}
    assert by == {1: "2", 2: "1", 9: None}
    with pytest.raises(CheckError):
        score(df, QUERIED_UNIQUE, query="SELECT {group} FROM {active_batch} GROUP BY {group}", value=3)


def test_names_of_any_kind(spark):
    for name in ("a b", "a.b", "a`b", "slice", "n", "key", "value", "order"):
        quoted = name.replace("`", "``")
        df = spark.createDataFrame([("x",), ("y",), ("y",)], f"`{quoted}` string")
        assert score(df, IN_SET, name, value_set=["x"])["failure"] == 2
        assert score(df, UNIQUE, name)["failure"] == 2
        assert score(df, DISTINCT_IN_SET, name, value_set=["x"])["failure"] == 1
        assert score(df, QUERIED_UNIQUE, columns=[name], value=2)["expectation_status"]
        assert score(df, IN_SET, name, by=name, value_set=["x"])["y"]["failure"] == 2
        assert score(df, QUERIED_UNIQUE, by=name, columns=[name], value=2)["y"]["expectation_status"]


def test_missing_column(spark):
    df = spark.createDataFrame([(1,)], "a int")
    for name in (NOT_NULL, UNIQUE):
        with pytest.raises(CheckError):
            score(df, name, "b")
        with pytest.raises(CheckError):
            score(df, name, None)
    assert score(df, NOT_NULL, "A")["failure"] == 0


def test_length(spark):
    df = spark.createDataFrame([("ab  ",)], "v string")
    assert score(df, LENGTH, "v", value=4)["failure"] == 0
    assert score(df, LENGTH, "v", value=2)["failure"] == 1
    assert score(df, LENGTH, "v", value=2, rtrim=True)["failure"] == 0
    numbers_ = spark.createDataFrame([(123,), (4567,)], "v bigint")
    assert score(numbers_, LENGTH, "v", value=3)["failure"] == 1


def test_like_case(spark):
    df = spark.createDataFrame([("Ring",)], "v string")
    assert score(df, LIKE, "v", like_pattern="ring")["failure"] == 1
    assert score(df, LIKE, "v", like_pattern="ring", ignore_case=True)["failure"] == 0


def test_unique_with_null_keys(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "v int")
    assert numbers(score(df, UNIQUE, "v")) == (3, 0, True)
    df = spark.createDataFrame([(None,), (2,), (2,), (1,)], "v int")
    assert numbers(score(df, UNIQUE, "v")) == (4, 2, False)


def test_unique_by_slice(spark):
    df = spark.createDataFrame([("a", 7), ("b", 7), ("b", 8), ("b", 8)], "g string, v int")
    rows = score(df, UNIQUE, "v", by="g")
    assert numbers(rows["a"]) == (1, 0, True)
    assert numbers(rows["b"]) == (3, 2, False)
    assert numbers(score(df, UNIQUE, "v")) == (4, 4, False)


def test_empty_table(spark):
    df = spark.createDataFrame([], "v string")
    assert numbers(score(df, NOT_NULL, "v")) == (0, 0, True)
    assert numbers(score(df, UNIQUE, "v")) == (0, 0, True)
    row = score(df, DISTINCT_IN_SET, "v", value_set=["a"])
    assert numbers(row) == (0, 0, True) and row["details"] == "0 distinct values, 0 outside the set"
    assert score(df, QUERIED_UNIQUE, columns=["v"], value=0)["expectation_status"] is True


def test_mostly(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    assert score(df, IN_SET, "v", value_set=["a"], mostly=0.66)["expectation_status"] is True
    assert score(df, IN_SET, "v", value_set=["a"], mostly=0.67)["expectation_status"] is False
    assert score(df, NOT_NULL, "v", mostly=0.75)["expectation_status"] is True
    assert score(df, NOT_NULL, "v", mostly=0.76)["expectation_status"] is False
    assert score(df, UNIQUE, "v", mostly=0.33)["expectation_status"] is True
    for bad in (2, -0.1, "1", True):
        with pytest.raises(CheckError):
            score(df, NOT_NULL, "v", mostly=bad)


def test_row_condition(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "v string, n int")
    row = score(df, IN_SET, "v", value_set=["a"], row_condition="n < 3 OR n > 3")
    assert numbers(row) == (3, 1, False)
    assert numbers(score(df, UNIQUE, "v", row_condition="n <> 3")) == (3, 0, True)
    row = score(df, DISTINCT_IN_SET, "v", value_set=["a"], row_condition="n = 1")
    assert numbers(row) == (1, 0, True)
    assert score(df, QUERIED_UNIQUE, columns=["v"], value=2, row_condition="n > 1")["details"] == "2"
    with pytest.raises(PySparkException):
        score(df, NOT_NULL, "v", row_condition="no_such_column = 1")


def test_unknown_check(spark):
    df = spark.createDataFrame([("a",), ("b",)], "v string")
    row = score(df, "no_such_check", "v")
    assert row["expectation_status"] is None and row["details"] == "unknown check"
    sliced = score(df, "no_such_check", "v", by="v")
    assert sliced.keys() == {"a", "b"} and sliced["a"]["details"] == "unknown check"


def test_registered_checks(spark):
    df = spark.createDataFrame([(1, "a"), (5, "a"), (9, "b")], "v int, g string")
    register_row_check("test_at_most", lambda col, params: col > params["limit"])
    assert numbers(score(df, "test_at_most", "v", limit=4)) == (3, 2, False)
    register_query_check(
        "test_rows",
        "SELECT count(*) FROM {active_batch}",
        lambda observed, params: observed >= params["least"],
    )
    row = score(df, "test_rows", least=3)
    assert row["expectation_status"] is True and row["details"] == "3"
    sliced = score(df, "test_rows", by="g", slices=["a", "b", "c"], least=2)
    assert [sliced[s]["details"] for s in "abc"] == ["2", "1", "0"]
    assert [sliced[s]["expectation_status"] for s in "abc"] == [True, False, False]


def test_slices_add_up(spark):
    df = spark.createDataFrame([(str(i % 4), i % 7) for i in range(200)], "g string, v int")
    sliced = score(df, IN_SET, "v", by="g", value_set=[1, 2])
    full = score(df, IN_SET, "v", value_set=[1, 2])
    assert sum(r["failure"] for r in sliced.values()) == full["failure"]
    assert sum(r["scanned"] for r in sliced.values()) == full["scanned"]
