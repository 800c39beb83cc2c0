"""A corpus pipeline of the operators over documents: each stage works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from archivetables import ship_package
from archivetables.llm import bpe, exact_dedup, fertility, jaccard, mixing
from archivetables.llm.common import documents, written
from archivetables.llm.queries import vocabularies
from archivetables.session import delete_scratch, scratch_folders

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_held: dict[str, list[str]] = {}  # scratch folders that earlier stages left, by application


def stage(function: Stage) -> Stage:
    """A stage that deletes the scratch tables of stages before it, whose results are written by then:
    it keeps them where ``docs`` still reads one. Every stage takes tables without rows, null and empty
    texts, repeated rows and ids, and further columns of any name, which it hands on."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        earlier = _held.setdefault(spark.sparkContext.applicationId, [])
        if earlier:
            read = "\n".join(docs.inputFiles())
            if not any(folder.rpartition("/")[2] in read for folder in earlier):
                delete_scratch(spark, earlier)
                earlier.clear()
        with scratch_folders() as made:
            result = function(spark, docs, sf_dir)
        earlier += made
        return result

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits or the tokeniser bands reject go, those without text among them."""
    return fertility.kept_documents(docs, **vocabularies())


@stage
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest ``doc_id`` stays; null texts count as empty."""
    return exact_dedup.without_copies(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shared five-word shingles (0.8 of the union), the one with the smallest
    ``doc_id`` stays. Documents without words are linked with nothing."""
    return jaccard.without_similar(docs, words=5, percent=80)


@stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their weights: a row for every copy that the mix takes. A null source is one of
    its own; documents without words are not taken."""
    return mixing.mixed_documents(docs)


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text; none where there is no text."""
    encoded = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return bpe.digests(encoded, "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

# Tokenisers and iterative stages are beyond SQL; the tests hold the stages to plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), []
    for number, (_, function) in enumerate(STAGES[:-1]):
        docs = function(spark, docs, sf_dir)
        with scratch_folders() as result:
            docs = written(docs, f"pipeline-{number}")
        delete_scratch(spark, before)
        before = result
    return STAGES[-1][1](spark, docs, sf_dir)
