"""One query per operator, each over its whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm import chunks, jaccard, lines, lm, mixing, nearvec, pagetext, pieces, quality, ranked, shards, topk, variants
from loadcast.llm.store import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), to_ends=True)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract_pages(table(spark, sf_dir, "pages"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_documents(table(spark, sf_dir, "documents"))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearvec.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", *quality.BASE_METRICS[1:], "n_stop_words", "n_stutters",
        "base_failed", "kept")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"))


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_vectors(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_near_vectors": op4_near_vectors,
    "op5_sharding": op5_sharding,
    "op6_line_dedup": op6_line_dedup,
    "op7_source_mixing": op7_source_mixing,
    "op8_quality_rules": op8_quality_rules,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_topk_search": op11_topk_search,
    "op12_ranked_search": op12_ranked_search,
    "op13_spelling_variants": op13_spelling_variants,
}
