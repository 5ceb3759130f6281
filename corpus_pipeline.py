"""The corpus pipeline: language, quality, near-duplicates, benchmark leaks,
packing. Each stage is one operator of ``bowline.llm`` over everything that the
stage before it kept, which is written as Parquet and read again in between.

Defined results of the stages: texts that are null, empty or without letters go at
the first one; rows without a doc_id are judged like others and are never copies of
one another; repeated rows are judged alike, and near_dedup keeps one of them. All
columns but those that a stage needs pass through, whatever their names. Empty
tables give empty tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bowline.llm import bytecnn_lang, decontam, gam_quality, minhash_tensor, packing
from bowline.llm.common import Scratch, importable
from bowline.sources.corpus import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, or in no learned language, go."""
    importable(spark)
    return bytecnn_lang.keep_known(spark, docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts scored below the threshold go."""
    importable(spark)
    return gam_quality.keep_quality(spark, docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the
    document with the smallest id stays."""
    importable(spark)
    return minhash_tensor.drop_near_duplicates(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    importable(spark)
    return decontam.decontaminate(spark, docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces placed in sequences."""
    importable(spark)
    return packing.pack_documents(spark, docs)


STAGES = [("language_id", language_id), ("quality", quality), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", pack)]

# Trained models and a tokenizer decide here, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
