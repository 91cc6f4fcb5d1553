"""Documents to packed training sequences: five stages, each a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm import decontam, langid, packing, simhash, suffixes
from tidewater.llm.common import tuned, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language."""
    tuned(spark)
    return langid.without_unknown(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    tuned(spark)
    return simhash.without_near_copies(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones have."""
    tuned(spark)
    return suffixes.cut_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item leaks."""
    items = tuned(spark).read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontam.without_leaks(docs, decontam.as_question_and_answer(items))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 1024 tokens."""
    tuned(spark)
    pieces = packing.token_pieces(docs)
    return packing.best_fit(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    )


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Language models, fingerprints and token ids cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written and read by the next."""
    found = tuned(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        found = written(stage(spark, found, sf_dir), name)
    return STAGES[-1][1](spark, found, sf_dir)
