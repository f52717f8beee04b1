"""What several corpus operators share: kept tables, global numbering, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: ASCII white space as the contracts write it; a word is a run of anything else.
SPACE = "\x20\x09-\x0d"
WORD = re.compile(rf"[^{SPACE}]+")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that few texts at a time become Python objects; gives memory back at the end."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def packed(docs: DataFrame) -> DataFrame:
    """text, and all other columns as the struct `row`, so that columns of any name pass through an operator."""
    return docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"))


def unpacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns that `packed` put away, in their order."""
    return df.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns))


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which driver and executors share; in local mode one is made if none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='assayer-')}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of this application in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """`df` written to the shared folder and read again: lineage ends there, and lost executors cost nothing before it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fixed(df: DataFrame) -> DataFrame:
    """`df` as a reliable checkpoint: partitions and the order within them stay as they are."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def numbered(df: DataFrame, keys: Sequence[Column], position: str = "position") -> DataFrame:
    """The rows of `df` with their place from 0, without gaps, in the order of `keys`.

    Rows are dealt out by range and sorted there; a place is a partition's offset plus the row's place in it. Rows that are
    equal in all keys are told apart by where they lay before, so that any number of them spreads over several partitions.
    Only one count per partition is broadcast.
    """
    tied = fixed(df).withColumn("_tie", F.monotonically_increasing_id())
    order = [*keys, F.col("_tie")]
    ranged = fixed(tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie"))
    placed = ranged.withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumn("_part", F.shiftright("_at", 33)).withColumn(
        "_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(position, F.col("_offset") + F.col("_at"))
        .drop("_part", "_at", "_offset")
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b), root being the least node that links reach; all columns bigint.

    Large-star and small-star rounds: every node hands its neighbours to the least of them, until each node has only its
    root. A round is two groupings, whose results are kept, so lineage never grows; the number of rounds grows with the
    logarithm of a component's diameter. Only a comparison of two counts comes to the driver. Links to a node itself and
    repeated links are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = kept(edges, "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = kept(large, "large-star")
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u")
        edges = kept(
            small.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct(),
            "small-star",
        )
        now = edges.agg(
            F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))
        ).first()
        if now == before or not now[0]:
            roots = edges.select("v", "v").distinct()
            return edges.union(roots).toDF("node", "root")
        before = now
