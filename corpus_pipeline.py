"""From documents to token ids: five training-data operators in a row.

Each stage gets what its predecessor kept, written as Parquet to the shared
folder and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import bpe, decontamination, line_dedup, quality, simhash
from eventide.llm.common import discard, made, saved, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed limits and the trees fitted on ``labels`` accept."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that many of them share; ``n_chars`` follows where it is given."""
    return line_dedup.rewrite(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ``benchmark``."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return bpe.encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", lines),
    ("simhash", near_duplicates),
    ("decontamination", benchmark),
    ("byte_bpe", byte_bpe),
]

#: The boosted trees of the first stage have no SQL form; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one.

    Once a stage is written, its working tables and its predecessor's rows are deleted.
    """
    docs, first = table(spark, sf_dir, "documents"), made()
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
        discard(spark, first)
    return docs
