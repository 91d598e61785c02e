"""The registered queries of the llm operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import (hnsw, html, jaccard, merkle, mixing, oracles, packing, phrases, quality, secrets, sharding, substrings,
                           toxicity, whitening)


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_main_text(spark: SparkSession, d: str) -> DataFrame:
    return html.extract_pages(_table(spark, d, "pages"))


def op2_pareto_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(_table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op4_phrase_index(spark: SparkSession, d: str) -> DataFrame:
    found = phrases.contamination(_table(spark, d, "documents"), _table(spark, d, "benchmark"))
    return found.select("doc_id", F.col("n_words"), F.size("hits").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"))


def op5_vector_graphs(spark: SparkSession, d: str) -> DataFrame:
    return hnsw.near_vectors(_table(spark, d, "embeddings"))


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op7_lookup_shards(spark: SparkSession, d: str) -> DataFrame:
    return sharding.placed(_table(spark, d, "documents").select("doc_id"))


def op8_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, d, "documents"))


def op9_secrets(spark: SparkSession, d: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, d, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op10_suffix_automata(spark: SparkSession, d: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, d, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_lanczos_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whitened(_table(spark, d, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return merkle.manifest(_table(spark, d, "documents"))


def op13_multi_length_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(_table(spark, d, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "padded", "step")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_main_text": op1_main_text,
        "op2_pareto_mix": op2_pareto_mix,
        "op3_quality": op3_quality,
        "op4_phrase_index": op4_phrase_index,
        "op5_vector_graphs": op5_vector_graphs,
        "op6_toxicity": op6_toxicity,
        "op7_lookup_shards": op7_lookup_shards,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_secrets": op9_secrets,
        "op10_suffix_automata": op10_suffix_automata,
        "op11_lanczos_whitening": op11_lanczos_whitening,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_multi_length_packing": op13_multi_length_packing,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    texts = {
        "op2_pareto_mix": mixing.ORACLE,
        "op4_phrase_index": oracles.PHRASES,
        "op5_vector_graphs": oracles.VECTORS,
        "op7_lookup_shards": sharding.ORACLE,
        "op8_jaccard_join": oracles.JACCARD,
        "op10_suffix_automata": oracles.REPEATS,
    }
    return texts | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
