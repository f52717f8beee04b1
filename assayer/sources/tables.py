"""Tables under test, whole or one run slice at a time."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from assayer.functions.columns import column, column_type, quoted, typed_literal, typed_texts
from assayer.sources.jdbc import read_jdbc

Tables = Callable[[str, str], DataFrame]


def parquet_tables(spark: SparkSession, base: str) -> Tables:
    """Tables as `<base>/<table>.parquet`, whatever the schema name."""
    return lambda schema, table: spark.read.parquet(f"{base}/{table}.parquet")


def catalog_tables(spark: SparkSession) -> Tables:
    return lambda schema, table: spark.table(f"{quoted(schema)}.{quoted(table)}")


def jdbc_tables(
    spark: SparkSession, url: str, by_table: Mapping[str, Mapping] | None = None, **options
) -> Tables:
    """Tables of a database; `options` as for `read_jdbc`, and `by_table` those of single tables, such
    as how to split them. Filters and columns are pushed down."""

    def table(schema: str, name: str) -> DataFrame:
        full = f"{schema}.{name}"
        return read_jdbc(spark, url, table=full, **{**options, **(by_table or {}).get(full, {})})

    return table


def run_slice(table: DataFrame, run_column: str, run_value) -> DataFrame:
    """The rows of one pipeline run, compared in the column's own type so that the filter reaches
    the files (and picks partitions, where the table is partitioned by the run)."""
    dtype = column_type(table, run_column)
    (text,) = typed_texts(table.sparkSession, [run_value], dtype)
    return table.filter(column(run_column) == typed_literal(text, dtype))

