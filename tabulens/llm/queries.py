"""Registered queries of the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabulens.llm import chat, collocations, language_id, mixing, packing, pieces, prefix_trie, quality_rules, simhash, sketches, suffix_dedup, toxicity, warc
from tabulens.llm.common import staged, table
from tabulens.llm.oracles import ORACLES
from tabulens.session import shared_folder


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    counted = quality_rules.counts(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    return quality_rules.score(staged(counted, "quality-counts"), ["doc_id"])


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(table(spark, folder, "documents"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    written = staged(warc.write(table(spark, folder, "pages"), archives), "warc-files")
    return warc.read(written, archives).drop("url")


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.compare_edited(table(spark, folder, "documents"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    parser = language_id.fit(docs.where("doc_id is not null").where(~language_id.held_out(F.col("doc_id"))))
    found = language_id.identify(docs, parser, ["doc_id"])
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels").select("doc_id", "toxic")
    learned = labels.where("doc_id is not null").where(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(docs, learned)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, i, role, r"\### Assistant: </turn> ok") for i, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.format_turns(conversations))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    mine = [op1_quality_rules, op2_suffix_dedup, op3_simhash, op4_sentencepiece, op5_warc, op6_fingerprints, op7_packing, op8_language_id, op9_toxicity, op10_chat, op11_prefix_trie, op12_mixing, op13_collocations]
    return {f.__name__: f for f in mine} | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    import corpus_pipeline

    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
