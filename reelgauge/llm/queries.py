"""The registered query of each operator, over whole tables and with production parameters."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from reelgauge.llm import (
    bpe,
    chat_format,
    exact_dedup,
    hard_negatives,
    language_id,
    license_scan,
    merkle,
    mixing,
    quality_classifier,
    quality_rules,
    simhash,
    token_store,
    url_filter,
)
from reelgauge.llm.words import lower_ascii
from reelgauge.session import scratch_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, _read(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).select(
        "doc_id",
        quality_classifier.in_fold(F.col("doc_id"), 0).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(_read(spark, sf_dir, "documents"), simhash.EXACT)
    return found.select("doc_id", F.lower(F.lpad(F.hex("a"), 16, "0")).alias("fingerprint"), "component_id")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    conversations = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionAll(planted)
    return chat_format.read_back(chat_format.format_turns(conversations))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(_read(spark, sf_dir, "documents"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write(_read(spark, sf_dir, "documents"), path, _vocabulary("word_bpe_49k.json"), end_id=1)
    return token_store.documents(token_store.read(spark, path))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.membership(_read(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_read(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "base_failed",
        F.array_join("failed", " ").alias("failed"), "kept",
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_read(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, spec = _read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json")
    return bpe.encode(docs, spec, bpe.lexicon(docs, spec), decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claimed = F.when(tampered, merkle.leaf_of(docs, fields, text=lower_ascii(F.col("text"))))
    proofs = merkle.proofs(merkle.manifest(docs, fields, group="lang", order="doc_id", claimed=claimed))
    return proofs.select(
        F.col("order").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs, held_out=1)).select(
        "doc_id", F.coalesce(language_id.in_fold(F.col("doc_id"), 1), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_simhash_near_dedup,
        op3_chat_format,
        op4_source_mixing,
        op5_token_store,
        op6_exact_dedup,
        op7_license_scan,
        op8_quality_rules,
        op9_url_filter,
        op10_bpe,
        op11_hard_negatives,
        op12_merkle_manifest,
        op13_language_id,
    )
} | {"pipeline": corpus_pipeline.run}
