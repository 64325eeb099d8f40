"""A corpus pipeline: language, near duplicates, repeated passages, benchmark leaks, mixing.

``run`` applies the stages one after the other.  Each is written as Parquet to the shared
folder and read again as the next one's documents, so a stage that is lost starts anew from
the table before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorspark.catalog.registry import query
from sensorspark.llm import chaining, decontaminate, langid, mixing, simhash
from sensorspark.llm.common import table
from sensorspark.session import fresh_path, pin


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    pin(spark)
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by fingerprints as in op4 and by similar shingles."""
    pin(spark)
    return simhash.keep_one(docs, most=simhash.MOST)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds."""
    pin(spark)
    return chaining.without_passages(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark text."""
    pin(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words of; a document it takes none of goes.

    ``taken`` is the repeat weight in words: a trainer reads the text ``taken`` divided by ``size``
    times, the last time in part.  Texts are neither repeated nor cut here.
    """
    pin(spark)
    return mixing.mix(docs).filter("taken > 0")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("source_mix", source_mix),
]

# SQL can express neither the language model nor the fuzzy comparisons.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


@query("pipeline")
def _pipeline(t):
    return run(t.spark, t.directory)
