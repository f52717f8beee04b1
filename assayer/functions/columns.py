"""Column references and typed literals."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.model import CheckError
from assayer.sources.local import local_frame


def quoted(name: str) -> str:
    """`name` as a Spark identifier, whatever blanks, dots or backticks it holds."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def free_names(source: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """`wanted`, each with as many prefixes `check_` as it takes to differ from the source's columns (in any
    case of letters) and from each other."""
    taken, names = {name.lower() for name in source}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"check_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def column_type(df: DataFrame, name: str | None) -> T.DataType:
    """Type of a top-level column; refuses a missing one with the names there are."""
    if not name or not isinstance(name, str):
        raise CheckError("the check needs a column")
    for spelled in (lambda s: s, str.lower):
        for fld in df.schema.fields:
            if spelled(fld.name) == spelled(name):
                return fld.dataType
    raise CheckError(f"no column {name!r} among {df.columns}")


def json_text(value) -> str:
    """A JSON scalar as the text Spark casts from."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (str, int, float)):
        return str(value)
    raise CheckError(f"not a plain value: {value!r}")


def typed_texts(spark: SparkSession, values: Iterable, dtype: T.DataType) -> list[str]:
    """Texts of the distinct non-NULL `values`, all of which cast to `dtype`, as the type spells them.

    A value that does not cast is refused here: cast to NULL inside a query it would make `NOT IN`
    true for no row at all. NULLs are dropped for the same reason.
    """
    texts = list(dict.fromkeys(json_text(v) for v in values if v is not None))
    if not texts:
        raise CheckError("the value set is empty")
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        raise CheckError(f"values cannot be compared with type {dtype.simpleString()}")
    if isinstance(dtype, T.StringType):
        return texts
    spelled = F.col("v").try_cast(dtype).cast("string").alias("spelled")
    rows = local_frame(spark, [(t,) for t in texts], "v string").select("v", spelled).collect()
    bad = [r["v"] for r in rows if r["spelled"] is None]
    if bad:
        raise CheckError(f"not of type {dtype.simpleString()}: {bad}")
    zero = ("0.0", "-0.0")  # one value to Spark's comparisons
    return list(dict.fromkeys(zero[0] if r["spelled"] in zero else r["spelled"] for r in rows))


def typed_literal(text: str, dtype: T.DataType) -> Column:
    """A literal of the column's own type; constant folding leaves a plain value to push down."""
    return F.lit(text) if isinstance(dtype, T.StringType) else F.lit(text).cast(dtype)


# Text keys longer than this many bytes are grouped by their SHA-256.
KEY_BYTES = 64


def group_key(df: DataFrame, name: str) -> Column:
    """A column as a grouping key: long texts by their digest, so that grouping documents shuffles
    some bytes of each and not the document. A digest with its mark is longer than any text that is
    kept as it is, so the two cannot be taken for each other."""
    dtype = column_type(df, name)
    col = column(name)
    if dtype != T.StringType():
        return col
    digest = F.concat(F.lit("#"), F.sha2(col, 256))
    return F.when(F.octet_length(col) > KEY_BYTES, digest).otherwise(col)
