"""Documents to training sequences: filter by quality, drop copies, mix sources, pack.

Each stage reads what the stage before has written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.common import new_folder, table
from gridmart.llm.exact_dedup import drop_exact_duplicates
from gridmart.llm.mixing import mix_sources
from gridmart.llm.packing import op8_binary_packing
from gridmart.llm.quality import keep_good, learn
from gridmart.llm.simhash import keep_one_of_near

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on these documents' labels, does not reject."""
    return keep_good(docs, learn(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id."""
    return keep_one_of_near(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources have equal weight."""
    return mix_sources(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, with its place in the sequences."""
    return op8_binary_packing(spark, sf_dir, docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_dedup", near_stage),
    ("mix_sources", mix_stage),
    ("binary_packing", pack_stage),
]

#: A trained classifier and a tokenizer have no SQL form; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each result but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
