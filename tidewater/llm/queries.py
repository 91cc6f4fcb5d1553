"""The queries of the operators, on whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm import (
    chat,
    common,
    decontam,
    kneser,
    langid,
    line_rules,
    merkle,
    negatives,
    neural_lm,
    oracle,
    packing,
    simhash,
    suffixes,
    token_rollup,
    topk,
)
from tidewater.session import new_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return common.tuned(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op7_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_copies(_table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(_table(spark, folder, "documents"))
    return packing.best_fit(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    )


def op2_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return token_rollup.maintained_totals(docs, new_folder(spark, "llm-rollup"))


def op4_text_scores(spark: SparkSession, folder: str) -> DataFrame:
    return neural_lm.score_texts(_table(spark, folder, "documents"))


def op6_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    return kneser.quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return langid.identify(docs, langid.language_model(docs))


def op10_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.without_repeats(_table(spark, folder, "documents"))
    removed = F.aggregate("span_lengths", F.lit(0).cast("bigint"), lambda total, one: total + one)
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("span_lengths").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_leaks(spark: SparkSession, folder: str) -> DataFrame:
    items = decontam.as_question_and_answer(_table(spark, folder, "benchmark"))
    return decontam.leaks(_table(spark, folder, "documents"), items)


def op3_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.line_rules(_table(spark, folder, "documents"))


def op8_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    text = F.lit("</s>[INST] ok [/INST]")
    more = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        text.alias("text"),
    )
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(chat.chat_windows(turns.unionByName(more)))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Where 2 divides the CRC-32 of doc_id, the text has lost its line ends since."""
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    lost = F.replace("text", F.lit("\n"), F.lit(""))
    now = F.when(odd, lost).otherwise(F.col("text"))
    found = merkle.manifest(_table(spark, folder, "documents"), now)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root", "verified",
    )


def op12_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh row is labelled anew."""
    vec_id, label = F.col("vec_id"), F.col("label")
    return negatives.hard_negatives(
        _table(spark, folder, "embeddings"),
        F.when(label.isNotNull() & (vec_id % 7 == 0), (label + 1) % 10).otherwise(label),
        vec_id % 100 == 0,
    )


def queries() -> dict:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    """Models, fingerprints and token ids cannot be said in SQL; the others are below."""
    return {
        "op3_line_rules": oracle.LINE_RULES,
        "op8_chat_windows": oracle.CHAT_WINDOWS,
        "op10_repeated_passages": oracle.REPEATED_PASSAGES,
        "op11_merkle_manifest": oracle.MERKLE_MANIFEST,
        "op12_top_k": oracle.TOP_K,
        "op13_hard_negatives": oracle.HARD_NEGATIVES,
    }
