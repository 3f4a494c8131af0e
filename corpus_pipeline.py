"""A training-data pipeline over ``documents``: each stage's rows are written as Parquet and read again by the next."""

from __future__ import annotations

import functools
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import bpe, mixing, quality, simhash, toxicity
from lodestar.session import checkpoint_dir, discard, ship_package, table


def _shipped(stage):
    """The stage, run after the workers have been given the package."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@_shipped
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the whole ``documents`` table."""
    return quality.keep_good(docs, quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@_shipped
def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; it learns from the whole ``documents`` table."""
    return toxicity.keep_civil(docs, toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@_shipped
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates."""
    return simhash.keep_one(docs)


@_shipped
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the target weights; a document may appear up to three times or not at all."""
    return mixing.mixed_copies(docs)


@_shipped
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers of every document, with digests of the ids and of the decoded bytes."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", civil),
    ("simhash near-dedup", one_of_each),
    ("mixing", mixed),
    ("byte-level BPE", encoded),
]

#: No stage but the last could be said in SQL: two learn from labels and two hash; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared checkpoint folder until the next has read it."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        place = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
        if number:
            discard(spark, f"{folder}/{number - 1}")
    return docs
