"""Queries over the given tables, one per operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.llm import bpe, chat, edits, lines, mixing, oracle, periodic, pii, repair, repeats, sampling, search, superminhash, toxicity
from panelwise.llm.common import table


def op1_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations"))


def op4_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.digest(table(spark, sf_dir, "documents"))


def op5_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edits.edited(table(spark, sf_dir, "documents"))
    return edits.counted(rows, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return search.search(docs, docs.filter("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "text"))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digest(repair.damaged(table(spark, sf_dir, "conversations")))


def op12_skipchain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(table(spark, sf_dir, "documents"))


def queries() -> dict:
    named = (
        op1_superminhash, op2_mixing, op3_chat, op4_sampling, op5_edits, op6_bpe, op7_search, op8_suffixes, op9_lines, op10_toxicity,
        op11_repair, op12_skipchain, op13_runs,
    )
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return oracle.sql()
