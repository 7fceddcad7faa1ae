"""The operators bound to the test tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalloom.llm import chat, decontamination, hard_negatives, language, licences, near_text, near_vectors, packing, repair, scoring, sharding, suffix_dedup, token_blocks
from evalloom.llm.oracles import ORACLE  # noqa: F401  (read with QUERIES)
from evalloom.sources import load

Query = Callable[[SparkSession, str], DataFrame]


def op1_log_bilinear(spark: SparkSession, base: str) -> DataFrame:
    fold = language.fold(F.col("doc_id"), 7)
    return scoring.score(load(spark, "documents", base), fold != 2, fold == 2)


def op2_cutting_stock(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack(load(spark, "documents", base))


def op3_interleaved_shards(spark: SparkSession, base: str) -> DataFrame:
    return sharding.interleave(load(spark, "documents", base), 24).drop("stratum")


def op4_benchmark_hits(spark: SparkSession, base: str) -> DataFrame:
    found = decontamination.benchmark_hits(load(spark, "documents", base), load(spark, "benchmark", base))
    return found.drop("hit_from", "hit_to")


def op5_language(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, "documents", base)
    fold = language.fold(F.col("doc_id"), 4)
    return language.identify(docs, language.fit(docs, fold != 2), held_out=fold == 2)


def op6_partenum_join(spark: SparkSession, base: str) -> DataFrame:
    return near_text.near_text(load(spark, "documents", base)).drop("row", "first_row")


def op7_repeated_strings(spark: SparkSession, base: str) -> DataFrame:
    return suffix_dedup.repeats(load(spark, "documents", base)).drop("row", "kept")


def op8_token_blocks(spark: SparkSession, base: str) -> DataFrame:
    return token_blocks.token_blocks(load(spark, "documents", base))


def op9_licences(spark: SparkSession, base: str) -> DataFrame:
    return licences.licence_scan(load(spark, "documents", base))


def op10_near_vectors(spark: SparkSession, base: str) -> DataFrame:
    return near_vectors.near_vectors(load(spark, "embeddings", base))


def op11_interval_repair(spark: SparkSession, base: str) -> DataFrame:
    return repair.damage_and_repair(load(spark, "conversations", base))


def op12_reply_trees(spark: SparkSession, base: str) -> DataFrame:
    turns = load(spark, "conversations", base).select("conv_id", "turn", "role", "text")
    # A conversation whose texts hold marks of common templates and an escape.
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return chat.digests(chat.format_trees(chat.chain(turns.union(planted))))


def op13_hard_negatives(spark: SparkSession, base: str) -> DataFrame:
    rows = load(spark, "embeddings", base).select(
        "vec_id", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label"),
        hard_negatives.whole_numbers("embedding").alias("vector"),
    )
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_log_bilinear, op2_cutting_stock, op3_interleaved_shards, op4_benchmark_hits, op5_language,
        op6_partenum_join, op7_repeated_strings, op8_token_blocks, op9_licences, op10_near_vectors,
        op11_interval_repair, op12_reply_trees, op13_hard_negatives,
    )
}
