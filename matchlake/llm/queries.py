"""One registered query per operator; each derives its columns from the operator's results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import chat, copies, decontam, importance, jaccard, mixing, pii, quality_rules, sharding, tokens, trie, urls, whitening
from matchlake.llm.common import read


def op1_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, read(spark, sf_dir, "labels"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    verdicts = quality_rules.quality_verdicts(docs, read(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, carry=["page_id"]).select("page_id", "host", "path", "rule", "verdict")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.leaks(docs, read(spark, sf_dir, "benchmark"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_table(chat.with_control_case(read(spark, sf_dir, "conversations")))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicate_groups(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [
        F.expr(f"cast(size(filter(base, x -> x.kind = {i})) AS long)").alias(f"n_{kind}")
        for i, kind in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(pii.spans_text("base")), 256).alias("base_sha256"),
        F.expr(pii.spans_text("spans")).alias("spans"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_table(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read(spark, sf_dir, "conversations"), rebuild=True)


def op13_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.copies_table(read(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_importance": op1_importance,
    "op2_sharding": op2_sharding,
    "op3_token_counts": op3_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_urls": op5_urls,
    "op6_decontamination": op6_decontamination,
    "op7_chat": op7_chat,
    "op8_jaccard": op8_jaccard,
    "op9_mixing": op9_mixing,
    "op10_pii": op10_pii,
    "op11_whitening": op11_whitening,
    "op12_trie": op12_trie,
    "op13_copies": op13_copies,
}
