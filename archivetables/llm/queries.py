"""A query per operator over the given tables, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivetables.llm import (
    bpe,
    conversations,
    credentials,
    exact_dedup,
    fertility,
    jaccard,
    licences,
    line_dedup,
    mixing,
    pii,
    quality,
    substrings,
    whitening,
)
from archivetables.llm.common import documents, hex_sha256


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score_documents(documents(spark, sf_dir), labels)


def vocabularies() -> dict[str, str]:
    """Parameters of ``fertility``: the installed public vocabularies."""
    return {
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pieces": public_tokenizers.path("piece_bpe_32k.model"),
        "pattern": public_tokenizers.PATTERN,
    }


def op2_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge_documents(documents(spark, sf_dir), **vocabularies())


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.encode_documents(documents(spark, sf_dir), vocabulary))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(documents(spark, sf_dir))
    return kept.withColumn("kept_sha256", hex_sha256(F.col("text"))).drop("text")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find_pii(documents(spark, sf_dir)))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(documents(spark, sf_dir), words=4, percent=85)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_rates(documents(spark, sf_dir))
    return mix.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "rate",
        "copies",
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(documents(spark, sf_dir))
    spans = F.transform("passages", lambda p: F.concat_ws(":", p["begin"], p["stop"]))
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        hex_sha256(F.col("kept")).alias("kept_sha256"),
        "n_words",
        "n_passage_words",
        F.size("passages").cast("long").alias("n_passages"),
        F.concat_ws(",", spans).alias("passages"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversations.summary(conversations.repair(damaged))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.summary(credentials.find_secrets(documents(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_fertility,
        op3_license_scan,
        op4_exact_dedup,
        op5_bpe,
        op6_line_dedup,
        op7_pii,
        op8_jaccard_join,
        op9_mixing,
        op10_substring_dedup,
        op11_conversation_repair,
        op12_whitening,
        op13_secret_scan,
    )
}
ORACLES = {
    "op3_license_scan": licences.scan_sql(),
    "op4_exact_dedup": exact_dedup.GROUPS_SQL,
    "op6_line_dedup": line_dedup.LINES_SQL,
    "op8_jaccard_join": jaccard.groups_sql(words=4, percent=85),
    "op11_conversation_repair": conversations.REPAIR_SQL,
}
