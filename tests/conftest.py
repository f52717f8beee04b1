import glob
import os

import duckdb
import pytest

from assayer.session import session

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", "local[8]", 8)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="session")
def sf():
    return SF
