"""Every registered query gives the rows, names and types of its SQL."""

import pytest

import __spark_entry__ as entry
from assayer.catalog.queries import ORACLE, QUERIES

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def ordered(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_each_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(name, spark, duck, sf):
    df = entry.queries()[name](spark, sf)
    duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in duck.description]
    assert {c: TYPES[t] for c, t in df.dtypes} == {d[0]: str(d[1]) for d in duck.description}
    assert ordered(df.collect(), df.columns) == ordered(duck.fetchall(), names)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 12
