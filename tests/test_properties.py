"""Random small tables: counts, rows and slices agree with each other and with plain Python."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assayer import Check, failed_rows, scorecard
from assayer.model import CONTAINS, IN_SET, LENGTH, LIKE, NOT_NULL, UNIQUE

CHECKS = {
    1: (Check(1, IN_SET, "v", {"value_set": ["a", "ab"]}), lambda v: v is not None and v not in ("a", "ab")),
    2: (Check(2, NOT_NULL, "v"), lambda v: v is None),
    3: (Check(3, LENGTH, "v", {"value": 1}), lambda v: v is not None and len(v) != 1),
    4: (Check(4, LIKE, "v", {"like_pattern": "a%"}), lambda v: v is not None and not v.startswith("a")),
    5: (Check(5, CONTAINS, "v", {"substring": "b"}), lambda v: v is not None and "b" not in v),
}

rows_of = st.lists(
    st.tuples(st.sampled_from("xyz"), st.one_of(st.none(), st.text("abü", max_size=3))), max_size=30
)
options = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@options
@given(rows=rows_of)
def test_row_checks(spark, rows):
    df = spark.createDataFrame(rows, "g string, v string")
    checks = [check for check, _ in CHECKS.values()]
    full = {r["config_id"]: r for r in scorecard(df, checks).collect()}
    sliced = scorecard(df, checks, by="g").collect()
    failed = Counter(r["expectation_name"] for r in failed_rows(df, checks, "r").collect())
    for i, (check, broken) in CHECKS.items():
        want = sum(broken(v) for _, v in rows)
        row = full[i]
        assert (row["scanned"], row["success"], row["failure"]) == (len(rows), len(rows) - want, want)
        assert row["expectation_status"] is (want == 0)
        assert failed[check.name] == want
        parts = [r for r in sliced if r["config_id"] == i]
        assert sum(r["failure"] for r in parts) == want
        assert sum(r["scanned"] for r in parts) == len(rows)


@options
@given(rows=rows_of)
def test_uniqueness(spark, rows):
    df = spark.createDataFrame(rows, "g string, v string")
    check = Check(1, UNIQUE, "v")
    (score,) = scorecard(df, [check]).collect()
    keys = Counter(v for _, v in rows if v is not None)
    repeated = {v: n for v, n in keys.items() if n > 1}
    assert (score["scanned"], score["failure"]) == (len(rows), sum(repeated.values()))
    every = failed_rows(df, [check], "r", unique_mode="all").count()
    extra = Counter(r["v"] for r in failed_rows(df, [check], "r").collect())
    assert every == score["failure"]
    assert extra == {v: n - 1 for v, n in repeated.items()}
