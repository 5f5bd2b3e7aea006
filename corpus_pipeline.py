"""From raw documents to packed training sequences: quality, language, near copies, repeated passages, packing.

Defined results: documents with null or empty texts are rejected by the quality stage; null ids stay until the operators of a stage say
otherwise (each operator's docstring does); extra columns go through all stages but the last; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabulens.llm import language_id, packing, quality_rules, simhash, suffix_dedup
from tabulens.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules reject go."""
    return quality_rules.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go. Learned from the rows that are not held out."""
    parser = language_id.fit(docs.where("doc_id is not null").where(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_identified(docs, parser)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.keep_representatives(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that also start earlier are cut out."""
    return suffix_dedup.cut_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their token ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [("quality_rules", quality), ("language_id", language), ("simhash", near_copies), ("suffix_dedup", passages), ("packing", sequences)]

#: Expectation-maximisation, cross-parsing, fingerprints, suffix order and tokens can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
