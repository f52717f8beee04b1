"""From documents to packed token windows: quality rules, line dedup, near-duplicates, source mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assayer.llm import lines, mixing, packing, quality, simhash
from assayer.llm.common import documents, kept


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the thresholds of their language and source accept."""
    return quality.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are repeated elsewhere."""
    return lines.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash fingerprints of three-word shingles link at 3 or fewer differing bits."""
    return simhash.one_each(docs, simhash.SHINGLE, simhash.BUDGET)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, once for each epoch."""
    return mixing.resampled(docs, mixing.DEFAULT, mixing.source_domain())


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of tokens, with their ids."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicates", near_duplicates),
    ("source mix", source_mix),
    ("packing", packed_windows),
]

#: Token ids cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; between stages the rows are kept in the shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
