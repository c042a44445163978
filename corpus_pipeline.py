"""From raw documents to training tokens, in stages that each read what the one before has written.

Every stage is a function (spark, docs, sf_dir) -> DataFrame. All but the last return the columns of
``documents``. ``run`` writes each stage's result as Parquet to the shared folder and reads it again, so a lost
executor costs at most the stage that is running.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm import bpe, exact_dedup, mixing, quality_classifier, simhash
from reelgauge.session import scratch_path, ship_package

#: No document is repeated here: the mix takes nine tenths of the tokens, each at most once.
MIX = mixing.Mix(weights=mixing.MIX.weights, percent=90, max_epochs=1)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject; it learns from the labels of the given documents."""
    ship_package(spark)
    model = quality_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.filtered(docs, model)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (three-word shingles, at most 2 of 64 bits apart)."""
    ship_package(spark)
    return simhash.deduplicated(docs, simhash.EXACT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fit the budgets of the domain, language and source tree."""
    return mixing.mixed(docs, mix=MIX)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the ids of the byte-level tokenizer (unsigned 32-bit, little endian)."""
    ship_package(spark)
    spec = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    encoded = bpe.encode(docs, spec, bpe.lexicon(docs, spec), keep=("doc_id", "lang", "source"))
    return encoded.select("doc_id", "lang", "source", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")


STAGES = [
    ("quality", quality),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("tokens", tokens),
]

#: The classifier, the fingerprints and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
