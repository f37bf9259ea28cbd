"""Corpus pipeline: quality rules, near copies, repeated passages, source mix, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaria.llm.mixing import mix_sources, repeat_rows
from vitaria.llm.packing import pack_documents, word_tokens
from vitaria.llm.quality import quality_rules
from vitaria.llm.simhash import keep_one
from vitaria.llm.substrings import mark_repeats
from vitaria.sinks.shared import keep_table


def _with_text(docs: DataFrame, names: list[str], text: str) -> DataFrame:
    """The named columns, with another text and its length."""
    changed = docs.withColumn("text", F.col(text))
    if "n_chars" in names:
        changed = changed.withColumn("n_chars", F.char_length("text").cast("long"))
    return changed.select(*[F.col(f"`{c}`") for c in names])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the frequent lines of their source."""
    return _with_text(quality_rules(docs).where("qr_kept"), docs.columns, "qr_text")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id."""
    return keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document of a lesser id has; those left without words go."""
    marked = mark_repeats(docs).where("rep_removed < rep_words or rep_words = 0")
    return _with_text(marked, docs.columns, "rep_kept")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out as the mix takes them."""
    return repeat_rows(mix_sources(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack_documents(docs, word_tokens(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("mix_sources", mixing_stage),
    ("packing", packing_stage),
]

#: Fingerprints, repeats by anchors and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
