"""Reading from and writing to databases with Spark's JDBC source. Errors raise."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime
from decimal import Decimal
from math import isfinite

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.columns import column

#: Relative error of the quantiles that cut a table: one over so much.
CUT_ACCURACY = 100_000
#: Columns of a staging table that say which write a row is of.
LOAD = "load_id"


def jdbc_read_options(
    url: str,
    query: str | None = None,
    table: str | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    **properties,
) -> dict[str, str]:
    """Options of one read: a table, or a query as a derived table.

    Without a partition column the read is one partition and one connection, so a large table needs
    one; bounds only place the cuts, no row outside them is lost.
    """
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    options = {
        "url": url,
        "dbtable": table if table is not None else f"({query}) source_query",
        "fetchsize": str(fetch_size),
    }
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("a partition column needs both bounds and the number of partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        }
    return options | {k: str(v) for k, v in properties.items()}


def read_jdbc(spark: SparkSession, url: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(url, **options)).load()


def partition_cuts(rows: DataFrame, name: str, num_partitions: int) -> list:
    """Values of a column that cut `rows` into about equal parts, ascending and distinct: quantiles of a mergeable sketch.

    `rows` is read for this column only, say by `read_jdbc` between equally wide bounds. A value that many rows have is one cut
    and no more, so there may be fewer parts than asked for. Without any values there are no cuts.
    """
    if num_partitions < 1:
        raise ValueError("there is at least one partition")
    if num_partitions == 1:
        return []
    shares = [i / num_partitions for i in range(1, num_partitions)]
    found = rows.agg(F.percentile_approx(column(name), shares, CUT_ACCURACY).alias("cuts")).first()["cuts"]
    return sorted({v for v in found or [] if v is not None and not (isinstance(v, float) and not isfinite(v))})


def sql_literal(value) -> str:
    """A number, date, timestamp or text as SQL has it."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"not a value to cut at: {value!r}")
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise ValueError(f"not a value to cut at: {value!r}")


def cut_predicates(name: str, cuts: Sequence, nullable: bool = True) -> list[str]:
    """One condition per partition: each row meets exactly one of them.

    A cut that stands for many equal rows begins its part, so those rows are together, but apart from all lesser ones. NULLs have a
    partition of their own. `name` is spelled as the database wants it.
    """
    ordered = sorted(set(cuts))
    at = [sql_literal(v) for v in ordered]
    if not at:
        parts = [f"{name} IS NOT NULL"]
    else:
        between = [f"{name} >= {low} AND {name} < {high}" for low, high in zip(at, at[1:])]
        # NOT of the others' bound, so that values a database orders last, such as NaN, are in the last part
        parts = [f"{name} < {at[0]}", *between, f"NOT ({name} < {at[-1]})"]
    return [*parts, f"{name} IS NULL"] if nullable else parts


def read_jdbc_cut(
    spark: SparkSession, url: str, table: str, name: str, cuts: Sequence, nullable: bool = True, fetch_size: int = 10_000, **properties
) -> DataFrame:
    """A table by `cut_predicates`, one connection per partition: parts of about one size also where a column's values crowd."""
    options = {k: str(v) for k, v in properties.items()} | {"fetchsize": str(fetch_size)}
    return spark.read.jdbc(url, table, predicates=cut_predicates(name, cuts, nullable), properties=options)


def write_jdbc(
    df: DataFrame, url: str, table: str, num_partitions: int | None = None, **properties
) -> None:
    """Append to a table. `num_partitions` bounds the connections.

    Each task commits by itself, so a task that is run again after its commit appends twice; where
    that matters, use `append_once`.
    """
    options = {"url": url, "dbtable": table} | {k: str(v) for k, v in properties.items()}
    if num_partitions is not None:
        options["numPartitions"] = str(num_partitions)
    df.write.format("jdbc").options(**options).mode("append").save()


def publish_sql(table: str, staging: str, columns: Sequence[str], keys: Sequence[str], load_id: str) -> str:
    """One statement that inserts the rows of a load that `table` does not have yet, by `keys`; NULL keys are equal to each other.

    The staging table may hold a row several times, as a task that is repeated writes its rows again: equal rows are one. The
    statement can be repeated, too.
    """
    if not keys or not set(keys) <= set(columns):
        raise ValueError("keys must be some of the columns")
    named = ", ".join(columns)
    own = ", ".join(f"s.{c}" for c in columns)
    same = " AND ".join(f"(t.{k} = s.{k} OR (t.{k} IS NULL AND s.{k} IS NULL))" for k in keys)
    return (
        f"INSERT INTO {table} ({named}) SELECT DISTINCT {own} FROM {staging} s "
        f"WHERE s.{LOAD} = {sql_literal(load_id)} AND NOT EXISTS (SELECT 1 FROM {table} t WHERE {same})"
    )


def clear_sql(staging: str, load_id: str) -> str:
    """The statement that empties the staging table of a load."""
    return f"DELETE FROM {staging} WHERE {LOAD} = {sql_literal(load_id)}"


def append_once(
    df: DataFrame,
    url: str,
    table: str,
    keys: Sequence[str],
    load_id: str,
    execute: Callable[[str], None],
    staging: str | None = None,
    write: Callable[..., None] = write_jdbc,
    **options,
) -> None:
    """Append rows that `keys` tell apart so that each is there once, whatever is repeated: a task, a load or all of it.

    Rows go to `staging` (default `<table>_staging`: the table's columns and `load_id`) by Spark's tasks, which may repeat them; one
    statement then moves those that are not yet there, and another clears the load. `execute` runs a statement on the
    database and commits it. A load that breaks off before the move leaves `table` as it was; it is run again under its id.
    """
    if not keys or not set(keys) <= set(df.columns):
        raise ValueError("keys must be some of the columns")
    if LOAD in df.columns:
        raise ValueError(f"the rows have a column {LOAD!r} of their own")
    staging = staging or f"{table}_staging"
    execute(clear_sql(staging, load_id))  # of an attempt that broke off
    write(df.withColumn(LOAD, F.lit(load_id)), url, staging, **options)
    execute(publish_sql(table, staging, df.columns, keys, load_id))
    execute(clear_sql(staging, load_id))
