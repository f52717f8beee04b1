"""Small frames from driver rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "double": pa.float64(),
    "timestamp": pa.timestamp("us", tz="UTC"),
}


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """`rows` as a DataFrame whose size Spark knows, so that it joins without a shuffle."""
    fields = T.StructType.fromDDL(schema).fields
    if not rows:
        return spark.createDataFrame([], schema)
    columns = {
        f.name: pa.array([row[i] for row in rows], _ARROW[f.dataType.simpleString()])
        for i, f in enumerate(fields)
    }
    return spark.createDataFrame(pa.table(columns))
