"""Corpus queries against their SQL in DuckDB, and whether all are there."""

import re

import pytest

import __spark_entry__ as entry
from assayer.llm.queries import ORACLE, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def ordered(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= entry.queries().keys()


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(name, spark, duck, sf):
    df = QUERIES[name](spark, sf)
    duck.execute(ORACLE[name])
    names = [d[0] for d in duck.description]
    assert {c: TYPES[t] for c, t in df.dtypes} == {d[0]: str(d[1]) for d in duck.description}
    assert ordered(df.collect(), df.columns) == ordered(duck.fetchall(), names)
