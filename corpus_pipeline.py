"""A corpus from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of ``documents``.  An outer
job writes each stage's rows and reads them again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronofold.llm import dart, langid, packing, phrases, quality
from chronofold.llm.queries import TOKENIZER
from chronofold.session import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known stay."""
    return langid.accepted(docs)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules stay."""
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document of the smallest id stays, in one row; no two different classes are merged, whatever their ids."""
    return dart.one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more that a document of a smaller id has are cut out; documents left without a word go."""
    return phrases.trimmed(docs)


def packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in training sequences."""
    return packing.packed(docs, TOKENIZER)


STAGES = [
    ("language ID", language),
    ("quality rules", rules),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", substrings),
    ("best-fit packing", packs),
]

#: A classifier, learned references and a local search take part: no SQL statement gives the same rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each over the rows that the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
