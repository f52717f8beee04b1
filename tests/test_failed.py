from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from assayer import Check, CheckError, failed_rows, scorecard
from assayer.model import CONTAINS, DISTINCT_IN_SET, IN_SET, NOT_NULL, QUERIED_UNIQUE, UNIQUE
from assayer.operators import keys, registry
from assayer.operators.failed import failed_schema
from assayer.operators.keys import repeated_rows


def skewed(n=4000):
    """A third of the rows hold one key; ids tell rows apart."""
    return [(i, "hot" if i % 3 == 0 else f"k{i % 700}", i % 5) for i in range(n)]


def brute(rows, key, mode):
    groups = defaultdict(list)
    for row in rows:
        if row[key] is not None:
            groups[row[key]].append(row)
    out = Counter()
    for group in groups.values():
        if len(group) > 1:
            order = sorted(group, key=lambda r: tuple((v is not None, v) for v in r))
            out.update(order if mode == "all" else order[1:])
    return out


@pytest.mark.parametrize("mode", ["all", "extra"])
@pytest.mark.parametrize("tie", [None, ["id"], ["n", "id"]])
@pytest.mark.parametrize("rows_per_salt, at_most", [(10, None), (1_000_000, 1 << 40), (10, 701)])
def test_repeated_rows_under_skew(spark, mode, tie, rows_per_salt, at_most):
    rows = skewed()
    df = spark.createDataFrame(rows, "id int, k string, n int").repartition(8)
    got = repeated_rows(df, ["k"], mode, tie, rows_per_salt, at_most)
    got = Counter(map(tuple, got.collect()))
    if tie == ["n", "id"] and mode == "extra":
        want = Counter()
        groups = defaultdict(list)
        for row in rows:
            groups[row[1]].append(row)
        for group in groups.values():
            want.update(sorted(group, key=lambda r: (r[2], r[0]))[1:])
    else:
        want = brute(rows, 1, mode)
    assert got == want


def test_many_hot_keys_are_all_salted(spark):
    rows = [(i, f"k{i % 9}", 0) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, k string, n int")
    got = Counter(map(tuple, repeated_rows(df, ["k"], "extra", ["id"], 10).collect()))
    assert got == brute(rows, 1, "extra")


@pytest.mark.parametrize("copies_per_task", [2, 3, 100_000])
def test_copies_are_counted_out(spark, monkeypatch, copies_per_task):
    monkeypatch.setattr(keys, "COPIES_PER_TASK", copies_per_task)
    rows = [("a", 1)] * 5 + [("b", 1), ("b", 2)] + [("c", 1)] + [(None, 1)] * 3
    df = spark.createDataFrame(rows, "k string, n int")
    assert Counter(map(tuple, repeated_rows(df, ["k"]).collect())) == Counter(
        {("a", 1): 4, ("b", 2): 1}
    )
    assert repeated_rows(df, ["k"], "all").count() == 7


def test_null_ties(spark):
    rows = [("a", None), ("a", 2), ("a", 3), ("b", 1), ("b", 5), ("c", None)]
    df = spark.createDataFrame(rows, "k string, n int")
    want = [("a", 2), ("a", 3), ("b", 5)]
    assert sorted(map(tuple, repeated_rows(df, ["k"], "extra", ["n"]).collect())) == want
    two = repeated_rows(df, ["k"], "extra", ["n", "k"]).collect()
    assert sorted(map(tuple, two)) == want
    assert sorted(map(tuple, repeated_rows(df, ["k"]).collect())) == want


def test_maps_need_a_tie(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2})], "id int, m map<string,int>")
    with pytest.raises(CheckError):
        repeated_rows(df, ["id"])
    with pytest.raises(CheckError):
        repeated_rows(df, ["id"], "some")
    assert repeated_rows(df, ["id"], "all").count() == 2


def test_float_keys(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2), (1.0, 3)], "k double, n int")
    assert repeated_rows(df, ["k"], "all", None, 1).count() == 2


def test_tags_and_union(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    checks = [
        Check(1, IN_SET, "v", {"value_set": ["a"]}),
        Check(2, NOT_NULL, "v"),
        Check(3, CONTAINS, "v", {"substring": "b"}, '{"substring" : "b"}'),
        Check(4, QUERIED_UNIQUE, None, {"columns": ["id"], "value": 0}),
        Check(5, "no_such_check", "v"),
    ]
    rows = failed_rows(df, checks, "r").collect()
    assert sorted((r["id"], r["expectation_name"], r["parameters"]) for r in rows) == [
        (1, CONTAINS, '{"substring" : "b"}'),
        (2, IN_SET, '{"value_set": ["a"]}'),
        (3, NOT_NULL, "{}"),
    ]
    assert {r["run_id"] for r in rows} == {"r"}


def test_no_failure_keeps_the_schema(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    for check in (Check(1, NOT_NULL, "v"), Check(2, "no_such_check", "v"), Check(3, UNIQUE, "v")):
        rows = failed_rows(df, [check], "r")
        assert rows.isEmpty()
        assert [(f.name, f.dataType) for f in rows.schema] == [
            (f.name, f.dataType) for f in failed_schema(df.schema)
        ]
    assert failed_schema(df.schema).fields[-1] == T.StructField("run_id", T.StringType())


def test_taken_tag_names(spark):
    df = spark.createDataFrame([(None, "load7")], "v string, run_id string")
    (row,) = failed_rows(df, [Check(1, NOT_NULL, "v")], "r").collect()
    assert row["run_id"] == "load7" and row["check_run_id"] == "r"


def test_row_condition_and_slices(spark):
    rows = [(1, "a", 7), (2, "b", 7), (3, "b", 7), (4, "b", 8)]
    df = spark.createDataFrame(rows, "id int, g string, v int")
    unique = Check(1, UNIQUE, "v", {"tie_columns": ["id"]})
    ids = [r["id"] for r in failed_rows(df, [unique], "r", by="g").collect()]
    assert ids == [3]
    conditioned = Check(2, IN_SET, "v", {"value_set": [8], "row_condition": "id > 1"})
    assert sorted(r["id"] for r in failed_rows(df, [conditioned], "r").collect()) == [2, 3]


@pytest.mark.parametrize("name", [IN_SET, DISTINCT_IN_SET])
def test_long_value_set(spark, monkeypatch, name):
    monkeypatch.setattr(registry, "INLINE_VALUES", 2)
    df = spark.createDataFrame([(i % 6,) for i in range(60)] + [(None,)], "v int")
    check = Check(1, name, "v", {"value_set": [1, 2, 3]})
    rows = failed_rows(df, [check], "r")
    assert rows.columns == ["v", "expectation_name", "parameters", "run_id"]
    assert Counter(r["v"] for r in rows.collect()) == {0: 10, 4: 10, 5: 10}


@pytest.mark.parametrize("by", [None, "g"])
@pytest.mark.parametrize("condition", [None, "id % 2 = 0"])
def test_value_sets_too_large_to_broadcast(spark, monkeypatch, by, condition):
    """Scores as with an IN list; nine tenths of the rows hold one value, and NULLs are many."""
    rows = [(i, "hot" if i % 10 else [None, "in 1", "out", "in 2"][i // 10 % 4], f"g{i % 3}") for i in range(900)] + [(1, "out", "odd ids only")]
    df = spark.createDataFrame(rows, "id int, v string, g string").repartition(6)
    params = {"value_set": ["hot", "in 1", "in 2", "in 3", None], "mostly": 0.97, **({"row_condition": condition} if condition else {})}
    checks = [Check(1, IN_SET, "v", params), Check(2, NOT_NULL, "v")]
    want = sorted(map(str, scorecard(df, checks, by).collect()))
    monkeypatch.setattr(registry, "INLINE_VALUES", 2)
    monkeypatch.setattr(registry, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = scorecard(df, checks, by)
        assert sorted(map(str, got.collect())) == want
        # the set meets counted values: below the join, on either side, there is an aggregate
        text = scorecard(df, checks[:1], by)._jdf.queryExecution().optimizedPlan().toString()
        join = text[text.index("Join LeftOuter") :]
        assert "Aggregate" in join and "id#" not in join.split("Aggregate")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_texts_are_told_apart(spark):
    long = "x" * 500
    texts = [long, long, long + "y", "short", "short", "#" + "0" * 64, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, v string")
    ids = sorted(r["id"] for r in repeated_rows(df, ["v"], "all").collect())
    assert ids == [0, 1, 3, 4]
    extra = repeated_rows(df, ["v"], "extra", ["id"]).collect()
    assert sorted(r["id"] for r in extra) == [1, 4]
    (row,) = scorecard(df, [Check(1, UNIQUE, "v")]).collect()
    assert (row["scanned"], row["failure"]) == (8, 4)


@pytest.mark.parametrize("at_most", [None, 10])
def test_ties_that_are_not_unique_lose_no_row(spark, at_most):
    rows = [("a", 5, 1), ("a", 5, 2), ("b", None, 3), ("b", None, 4), ("c", 1, 5), ("c", 1, 5), ("c", 2, 6), ("d", 1, 7)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    got = repeated_rows(df, ["k"], "extra", ["t"], keys_at_most=at_most)
    assert sorted(tuple(r) for r in got.collect()) == sorted([("a", 5, 2), ("b", None, 4), ("c", 1, 5), ("c", 2, 6)], key=str)


@pytest.mark.parametrize("schema", ["n int, k string, t string, m int", "k string, n int, m int, t string", "t string, n int, m int, k string", "n double, m int, t string, k string"])
@pytest.mark.parametrize("at_most", [None, 50])
def test_least_by_all_columns_whatever_their_order(spark, schema, at_most):
    """First columns that tie, NULLs among them, copies, and a text before the numbers."""
    names = [c.split()[0] for c in schema.split(", ")]
    values = [{"k": f"k{i % 7}", "n": None if i % 5 == 0 else i % 3, "m": i % 2, "t": f"t{i % 11}"} for i in range(120)]
    rows = [tuple(float(v[c]) if c == "n" and "n double" in schema and v[c] is not None else v[c] for c in names) for v in values * 2]
    df = spark.createDataFrame(rows, schema).repartition(5)
    got = repeated_rows(df, ["k"], "extra", None, 10, at_most).collect()
    assert Counter(map(tuple, got)) == brute(rows, names.index("k"), "extra")
    both = repeated_rows(df, ["k", "n"], "extra", None, 10, at_most).collect()
    groups = defaultdict(list)
    for row in rows:
        if row[names.index("n")] is not None:
            groups[row[names.index("k")], row[names.index("n")]].append(row)
    want = Counter(r for g in groups.values() for r in sorted(g, key=lambda r: tuple((v is not None, v) for v in r))[1:])
    assert Counter(map(tuple, both)) == want


def test_rows_with_maps_and_one_tie(spark):
    df = spark.sql("SELECT 1 AS k, 1 AS t, map('a', id) AS m FROM range(3)")
    assert repeated_rows(df, ["k"], "extra", ["t"]).count() == 2


HELPERS = ["__n", "__least", "__first", "__hash", "__splits", "__salt", "__key_salt", "__k0", "__r0", "__place", "__from", "__copy", "__config_id", "__HASH2"]


@pytest.mark.parametrize("mode, tie, rows_per_salt, at_most", [("all", None, 2, None), ("extra", ["id"], 2, None), ("extra", ["t"], 100, 50), ("extra", None, 100, None)])
def test_source_columns_with_names_of_helpers(spark, monkeypatch, mode, tie, rows_per_salt, at_most):
    """Violating rows are the source's own, whatever its columns are called."""
    monkeypatch.setattr(keys, "COPIES_PER_TASK", 2)
    schema = "id int, k string, t int, " + ", ".join(f"`{h}` int" for h in HELPERS)
    rows = [(i, f"k{i // 3}", 0 if tie == ["t"] else i, *range(100 + i, 100 + i + len(HELPERS))) for i in range(12)]
    rows += [rows[0]] * 7
    df = spark.createDataFrame(rows, schema)
    assert Counter(map(tuple, repeated_rows(df, ["k"], mode, tie, rows_per_salt, at_most).collect())) == brute(rows, 1, mode)
    key = spark.createDataFrame([(r[3], r[0]) for r in rows], "__hash int, `__r0` int")
    assert repeated_rows(key, ["__hash"], "all", ["__r0"], 2).count() == 8


def test_failed_rows_and_value_sets_with_names_of_helpers(spark, monkeypatch):
    monkeypatch.setattr(registry, "INLINE_VALUES", 1)
    df = spark.createDataFrame([("a", 1, 2, 3, 4), ("z", 5, 6, 7, 8)], "v string, __set_1 int, __in_set_1 int, __config_id int, __failing int")
    check = Check(1, IN_SET, "v", {"value_set": ["a", "b"]}, "p")
    assert [tuple(r) for r in failed_rows(df, [check], "r").collect()] == [("z", 5, 6, 7, 8, IN_SET, "p", "r")]
    assert scorecard(df, [check]).first()["failure"] == 1
