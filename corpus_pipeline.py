"""The corpus pipeline: toxic texts go, one text of each group of near copies stays, contaminated texts go, personal data
gets surrogates, and what is left is packed into token sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. The stages share executors one after
the other, whose memory does not shrink in between, so all of them hand texts to Python in batches of 4 MB. A stage called by
itself leaves the session so, as what it returns runs later; ``run`` restores the session's own setting.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import BATCH_BYTES, small_batches
from kerbside.llm.decontamination import decontaminate
from kerbside.llm.ngram_join import one_of_each_group
from kerbside.llm.packing import pack
from kerbside.llm.pii import anonymise
from kerbside.llm.queries import SURROGATE_KEY
from kerbside.llm.toxicity import without_toxic
from kerbside.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with the session set to batches of 4 MB from then on."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_BYTES, str(4 << 20))
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts predicted to be toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@in_small_batches
def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by five-word shingles at 0.8 the one with the least id stays."""
    return one_of_each_group(docs, size=5, percent=80)


@in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with enough words inside benchmark passages go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@in_small_batches
def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced; n_chars follows the text."""
    return anonymise(docs, SURROGATE_KEY).withColumn("n_chars", F.length("text").cast("long"))


@in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]
# Trained models, surrogates and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; what a stage returns is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with small_batches(spark):
        for name, stage in STAGES[:-1]:
            docs = materialise(stage(spark, docs, sf_dir), name)
        return STAGES[-1][1](spark, docs, sf_dir)
