"""Whitening of embeddings: scatter and projection by distributed block matrices."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import kept

COMPONENTS = 16
#: Numbers in a block of the row matrix: 4 MB, of which a task holds a few.
BLOCK_CELLS = 1 << 19
#: Parts that partial scatters are summed in before they meet.
MOST_SPLITS = 4096
#: Eigenvalues below this part of their sum are rounding.
RANK = 1e-12
#: Rows with a vector that more rows than this share get its values by a broadcast, one row for each such vector.
HOT_COPIES = 1_000_000


def quantised(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """The entries c of a vector as whole numbers floor(scale * c) + shift; null where one is null, not finite or too large."""
    whole = F.transform(vector, lambda c: F.floor(scale * c.cast("double")) + shift)
    limit = float(1 << 62) / scale
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < limit))
    return F.when(vector.isNotNull() & F.coalesce(fine, F.lit(False)), whole)


@dataclass
class Whitening:
    """What the fit list of n distinct vectors gives: means as sums / n, eigenvalues and unit eigenvectors (columns) of its covariance."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    fit: DataFrame  # digest, copies, deviation, whitened (array by component)


def _summary(x: DataFrame) -> tuple[list[int], int, int]:
    """Sums by dimension, the least and the greatest entry; a row per dimension comes to the driver."""
    each = x.select(F.posexplode("x").alias("at", "value")).groupBy("at")
    rows = each.agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("s"), F.min("value").alias("low"), F.max("value").alias("high"))
    rows = sorted(rows.collect())
    return [int(r["s"]) for r in rows], min(r["low"] for r in rows), max(r["high"] for r in rows)


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> np.ndarray:
    """left * right for a small result. The inner dimension is dealt out to `splits` tasks, whose partial results are added up."""
    other = right._java_matrix_wrapper._java_model
    product = BlockMatrix(left._java_matrix_wrapper.call("multiply", other, splits), left.rowsPerBlock, right.colsPerBlock)
    return product.toLocalMatrix().toArray()


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of `vectors` (x: whole numbers, all of one length; digest: of x). None without rows.

    Distinct vectors are numbered without gaps; their centred rows are blocks of an MLlib BlockMatrix. Its transpose times itself is
    the scatter, whose eigenvectors are found on the driver (dimension by dimension numbers); the matrix times the whitening
    matrix projects all rows. Components are those of the largest eigenvalues that are not zero but for rounding.
    """
    listed = vectors.groupBy("digest", "x").agg(F.count("*").alias("copies"))
    listed = kept(listed.withColumn("at", F.monotonically_increasing_id()), "fit-list")
    # `at` is stored, so a place is the same whoever computes it: rows before its part, then its number there
    part = F.shiftright("at", 33)
    sizes = sorted(listed.groupBy(part.alias("part")).count().collect())  # a row per written part
    if not sizes:
        return None
    offsets, n = {}, 0
    for p, size in sizes:
        offsets[p], n = n, n + size
    first = listed.sparkSession.createDataFrame(list(offsets.items()), "part bigint, offset bigint")
    sums, low, high = _summary(listed)
    dims = len(sums)
    total = F.array(*map(F.lit, sums)).cast("array<decimal(38,0)>")
    spread = n * (high - low)  # |n * x - S| is at most this
    if n * max(abs(low), abs(high)) < 1 << 62 and dims * spread * spread < 1 << 62:
        total, exact = F.array(*map(F.lit, sums)).cast("array<bigint>"), "bigint"
    else:
        exact = "decimal(38,0)"
    rows = (
        listed.withColumn("part", part)
        .join(F.broadcast(first), "part")
        .select(
            "digest",
            "copies",
            (F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("index"),
            F.zip_with("x", total, lambda x, s: x.cast(exact) * F.lit(n).cast("bigint") - s).alias("y"),
        )
    )
    centred = F.transform("y", lambda y: y.cast("double") / float(n))
    features = rows.select("index", array_to_vector(centred).alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(features, "vector"), n, dims)
    matrix = indexed.toBlockMatrix(max(1, BLOCK_CELLS // dims), dims)
    splits = min(matrix.numRowBlocks, MOST_SPLITS)
    covariance = _product(matrix.transpose(), matrix, splits) / n
    values, unit = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")
    values, unit, trace = values[order], unit[:, order], float(np.trace(covariance))
    used = min(components, int((values > RANK * trace).sum())) if trace > 0 else 0
    values, unit = values[:used], unit[:, :used]
    square = F.aggregate("y", F.lit(0).cast("decimal(38,0)" if exact != "bigint" else "bigint"), lambda a, y: (a + y * y).cast(exact))
    plain = rows.select("digest", "copies", "index", square.cast("decimal(38,0)").alias("deviation"))
    if not used:
        nothing = F.array().cast("array<double>").alias("whitened")
        return Whitening(n, sums, values, unit, trace, 0.0, kept(plain.drop("index").select("*", nothing), "projected"))
    white = unit / np.sqrt(values)
    block = Matrices.dense(dims, used, white.flatten("F").tolist())
    spark = listed.sparkSession
    by_block = BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), dims, used, dims, used)
    projected = matrix.multiply(by_block)
    found = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    found = found.select("index", vector_to_array("vector").alias("whitened"))
    # whitened columns are sums of centred ones: their means are nought but for rounding
    error = float(np.abs(_product(projected.transpose(), projected, splits) / n - np.eye(used)).max())
    fit = kept(plain.join(found, "index").drop("index"), "projected")
    return Whitening(n, sums, values, unit, trace, error, fit)


def whitened(df: DataFrame, key: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """`key`, component (int, from 1), n, deviation, whitened, explained and identity_error of each row of `df` and each component.

    Entries are quantised (see `quantised`). Rows are left out whose vector is null or has an entry that is null or not finite, and
    those whose vector has another length than most (of equally many the longer one), as they are of another space. deviation
    (decimal): sum over dimensions of (n * x - S)^2; whitened: x - S / n on the component, over the root of its eigenvalue;
    explained: eigenvalue over trace; identity_error: how far the covariance of the whitened fit list is from the identity. There are
    as many components as `components` or, if that is less, the rank; none for a single distinct vector, and then no rows. Rows that
    repeat and null keys have their rows; columns of other names are not read; an empty table gives no rows.

    Vectors are shuffled once, to list the distinct ones with their number of copies; copies meet them again by digest, those of
    vectors with over a million copies by a broadcast, of which there are at most as many as there are millions of rows.
    """
    x = quantised(F.col(f"`{vector}`"))
    rows = df.select(F.col(f"`{key}`").alias("key"), x.alias("x")).filter("x IS NOT NULL AND size(x) > 0")
    digest = F.unhex(F.sha2(F.array_join(F.col("x").cast("array<string>"), ","), 256))
    rows = kept(rows.withColumn("digest", digest), "vectors")
    lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    columns = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    names = [key, *(c.split()[0] for c in columns.split(", "))]
    rows = rows.filter(F.size("x") == (lengths[0]["length"] if lengths else 0))
    model = fitted(rows.select("digest", "x"), components)
    if model is None:
        return rows.select("key", *(F.lit(None).cast(c.split()[1]) for c in columns.split(", "))).toDF(*names)
    hot = model.fit.filter(F.col("copies") > HOT_COPIES)
    members = rows.select("key", "digest")
    met = members.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(model.fit, "digest")
    met = met.unionByName(members.join(F.broadcast(hot), "digest"))
    shares = F.array(*(F.lit(float(e / model.trace)) for e in model.eigenvalues)).cast("array<double>")
    return met.select("key", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("key").alias(key),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
