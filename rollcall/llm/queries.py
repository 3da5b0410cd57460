"""Queries of this subpackage over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .conversation_repair import REPAIR_SQL, repair_damaged
from .decontaminate import LEAK_SQL, contamination
from .embedding_dedup import EMBEDDING_SQL, embedding_components
from .language_id import held_out, identify, train
from .license_scan import scan_licenses
from .line_dedup import dedupe_lines
from .lm_scoring import lm_scores
from .mixing import MIX_SQL, mix
from .quality import resample
from .simhash import simhash_components
from .suffix_dedup import REPEATS_SQL, remove_repeats
from .token_alignment import token_alignment
from .token_counts import token_counts


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = identify(docs, train(docs), keep=["doc_id"])
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir)).drop("text_hash")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir)).drop("detections")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).drop("text_hash")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedupe_lines(documents(spark, sf_dir).select("doc_id", "text"), every=True)
    kept = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return found.select("doc_id", "n_lines", "n_removed", F.length(kept).cast("long").alias("kept_bytes"), F.sha2(kept, 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_alignment(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_token_counts": op2_token_counts,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_simhash": op6_simhash,
    "op7_license_scan": op7_license_scan,
    "op8_mix": op8_mix,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality": op10_quality,
    "op11_repair": op11_repair,
    "op12_align": op12_align,
    "op13_lm_score": op13_lm_score,
}

ORACLE_SQL: dict[str, str] = {"op3_suffix_dedup": REPEATS_SQL, "op4_decontaminate": LEAK_SQL, "op5_embedding_dedup": EMBEDDING_SQL, "op8_mix": MIX_SQL, "op11_repair": REPAIR_SQL}
