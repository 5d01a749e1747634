"""The operators as registered queries over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.clustering import clusters
from kerbside.llm.common import crc32_mod
from kerbside.llm.conversation_repair import damage, repair
from kerbside.llm.cotraining import quality_classifier
from kerbside.llm.decontamination import contamination
from kerbside.llm.lm_scoring import lm_scores
from kerbside.llm.ngram_join import ngram_groups
from kerbside.llm.oracles import ORACLES
from kerbside.llm.packing import pack
from kerbside.llm.pii import KINDS, anonymise
from kerbside.llm.quality_rules import quality_rules
from kerbside.llm.secret_scan import BASE, count_of, listed, scan_secrets
from kerbside.llm.substring_dedup import remove_repeats
from kerbside.llm.token_output import checksums, read_tokens, write_tokens
from kerbside.llm.toxicity import toxicity
from kerbside.session import scratch_path


# The key of the registered runs; a deployment passes its own secret.
SURROGATE_KEY = b"registered-queries"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(_read(spark, sf_dir, "documents"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select(*first, *[c for c in out.columns if c not in first])


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op4_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc32_mod("doc_id") == 0
    scored = quality_classifier(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), train=~held_out)
    return scored.withColumns({"held_out": held_out, "kept": F.col("predicted") == 1})


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc32_mod("doc_id") == 1
    scored = lm_scores(_read(spark, sf_dir, "documents"), train=~held_out)
    return scored.withColumn("held_out", held_out)


def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-orc")
    write_tokens(_read(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return checksums(read_tokens(spark, path))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc32_mod("doc_id") == 0
    scored = toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), train=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("score"), F.col("predicted"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_read(spark, sf_dir, "documents"), size=50)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out = anonymise(docs, SURROGATE_KEY, counts_col="entities")
    total = F.aggregate(F.map_values("entities"), F.lit(0).cast("long"), lambda a, b: a + b)
    return out.select("doc_id", "text", total.alias("n_entities"), *[F.coalesce(F.col("entities")[k], F.lit(0)).alias(f"n_{k}") for k in KINDS])


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_groups(_read(spark, sf_dir, "documents"), size=3, percent=90)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_read(spark, sf_dir, "documents"))
    counts = [count_of(kind).alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(BASE), 256).alias("base_sha256"), listed().alias("spans"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(_read(spark, sf_dir, "conversations")), dropped_col="dropped")


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(_read(spark, sf_dir, "embeddings"), k=40, rounds=5, size=64, scale=256, salt="2:")


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_packing": op3_packing,
    "op4_cotraining": op4_cotraining,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_token_orc": op6_token_orc,
    "op7_toxicity": op7_toxicity,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_pii": op9_pii,
    "op10_ngram_join": op10_ngram_join,
    "op11_secret_scan": op11_secret_scan,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_clustering": op13_clustering,
}

__all__ = ["ORACLES", "QUERIES"]
