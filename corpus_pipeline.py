"""A corpus pipeline: documents to token ids, each stage written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from varve.llm.common import stored, table
from varve.llm.content_sort import exact_dedup
from varve.llm.part_enum import drop_near_copies
from varve.llm.positional_index import drop_contaminated
from varve.llm.suffix_pieces import round_trip
from varve.llm.toxicity import drop_toxic


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network does not reject."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similarity."""
    return drop_near_copies(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's piece ids and its text decoded from them."""
    return round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxic_out),
    ("exact dedup", copies_out),
    ("near duplicates", near_copies_out),
    ("decontamination", benchmark_out),
    ("sentencepiece", piece_ids),
]

# Learned scores and piece ids have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's rows are stored before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
