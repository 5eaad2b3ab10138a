"""The registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import decontaminate, fingerprint, language_id, licenses, near_dedup, oracles, pii, quality, secrets, sentencepiece_bpe, warc
from kinweave.llm.common import held_out, read


def sentencepiece_model(name: str = "piece_bpe_32k.model") -> str:
    """The place of a public tokenizer's file; KINWEAVE_TOKENIZERS may name another folder."""
    if folder := os.environ.get("KINWEAVE_TOKENIZERS"):
        return f"{folder}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = sentencepiece_bpe.Vocabulary.load(sentencepiece_model())
    out = sentencepiece_bpe.encode_decode(read(spark, sf_dir, "documents"), vocabulary)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(read(spark, sf_dir, "documents"))


def op4_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(read(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    out = quality.score(documents, quality.train(documents, read(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(read(spark, sf_dir, "pages"))).withColumnRenamed("key", "page_id")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    out = language_id.predict(documents, language_id.train(documents))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(read(spark, sf_dir, "documents"))


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secrets": op1_secrets,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_licenses": op3_licenses,
        "op4_weighted_sampling": op4_weighted_sampling,
        "op5_quality": op5_quality,
        "op6_pii": op6_pii,
        "op7_warc": op7_warc,
        "op8_language": op8_language,
        "op9_superminhash": op9_superminhash,
        "op10_spaced_seeds": op10_spaced_seeds,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secrets": oracles.SECRETS,
        "op9_superminhash": oracles.NEAR_DEDUP,
        "op10_spaced_seeds": oracles.SPACED_SEEDS,
    }
