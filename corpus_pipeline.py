"""The corpus pipeline: documents pass through five text operators, each stage written and read again.

Every stage takes all that its predecessor kept and returns the columns of ``documents``; the last returns tokens.

Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns of any name pass through each stage
as its operator defines it: a null or empty text is neither toxic nor a duplicate, and the mix, which counts words, does
not take it; rows without id are rows of their own; columns other than id, text and source keep their values.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelwise.llm import bpe, lines, mixing, superminhash, toxicity
from panelwise.llm.common import release, settled, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that came before; a document that loses all its words goes."""
    return lines.thinned(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words a shingle, a similarity of 0.8)."""
    return superminhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, to the nearest whole number."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and digests of them and of the decoded text."""
    return bpe.digest(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)


def _freeing(stage: Callable) -> Callable:
    """The stage, after freeing what the stages before it have broadcast: a stage begins when its input is written."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release()
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", _freeing(drop_toxic)),
    ("line_dedup", _freeing(drop_lines)),
    ("near_dedup", _freeing(drop_near_duplicates)),
    ("mixing", _freeing(mix_sources)),
    ("bpe", _freeing(encode)),
]

#: SQL cannot express the stages; tests compare them with direct evaluation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
