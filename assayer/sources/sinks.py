"""Results as Parquet in a folder all executors share.

Every run and batch has a folder of its own, laid out as partitions and replaced as a whole. So a run
that is started again under its id leaves one copy of its rows, and none of an earlier attempt.
"""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "check_batch"


def partition_path(path: str, **values: str) -> str:
    """`<path>/<name>=<value>/…` with values escaped the way Spark reads them back."""
    return "/".join([path, *[f"{k}={quote(str(v), safe='')}" for k, v in values.items()]])


def write_partition(df: DataFrame, path: str, **values: str) -> None:
    """Replace one partition; the partition columns are in the path, not in the files."""
    df.drop(*values).write.mode("overwrite").parquet(partition_path(path, **values))


def read_partitions(
    spark: SparkSession, path: str, schema: T.StructType | str, partitions: str
) -> DataFrame:
    """Read what `write_partition` wrote. The schema is given, so that a run id like `007` stays
    the text it is."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    named = {f.strip() for f in partitions.split(",")}
    full = T.StructType(
        [f for f in fields if f.name not in named]
        + [T.StructField(n.strip(), T.StringType()) for n in partitions.split(",")]
    )
    return spark.read.schema(full).parquet(path)


def read_partition(
    spark: SparkSession, path: str, schema: T.StructType | str, **values: str
) -> DataFrame:
    """Read one partition by its own path, whatever others there are; its columns as in `read_partitions`."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    files = T.StructType([f for f in fields if f.name not in values])
    df = spark.read.schema(files).parquet(partition_path(path, **values))
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def read_run(spark: SparkSession, path: str, schema: T.StructType | str, **values: str) -> DataFrame:
    """The batches of one run, read from the run's own folder: however many other runs there are, none is listed. A run that has
    written no batch has no rows."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    files = T.StructType([*[f for f in fields if f.name not in values], T.StructField(BATCH, T.StringType())])
    try:
        df = spark.read.schema(files).parquet(partition_path(path, **values))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], files)
    df = df.withColumns({name: F.lit(value) for name, value in values.items()})
    return df.select(*[f.name for f in fields if f.name not in values], *values, BATCH)


def write_ledger(
    ledger: DataFrame, base: str, snapshot: str, previous: DataFrame | None = None
) -> str:
    """Write a ledger snapshot to a path of its own and give the path.

    A run that is started again replaces its snapshot, but never the one it started from: `previous`
    is the ledger that was read, and overwriting its files would lose it.
    """
    path = partition_path(f"{base}/ledger", snapshot=snapshot)
    if previous is not None:
        place = path.split("://")[-1].rstrip("/") + "/"
        if any(place in unquote(f) or place in f for f in previous.inputFiles()):
            raise ValueError(f"the ledger is read from {path}: run under another id")
    ledger.write.mode("overwrite").parquet(path)
    return path


def read_ledger(spark: SparkSession, base: str, snapshot: str) -> DataFrame:
    return spark.read.parquet(partition_path(f"{base}/ledger", snapshot=snapshot))
