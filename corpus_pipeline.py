"""Corpus preparation in stages: each works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeferry.llm import compression, mixing, simhash, suffixes, tokens
from lakeferry.llm.common import landed, table
from lakeferry.sinks.storage import shared_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return compression.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark window go."""
    return suffixes.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Clean documents stay; low-quality and toxic ones are drawn down to their target shares of tokens."""
    return mixing.sampled(docs, table(spark, sf_dir, "labels"))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as token files: place, length and checksum of each document's ids, read back from them."""
    path = shared_path(spark, "corpus-tokens")
    tokens.write_tokens(docs, path)
    return tokens.read_tokens(spark, path)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_files", token_files),
]

#: Trained models, fingerprints and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage keeps is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
