"""A corpus pipeline: each stage takes the documents that the one before has kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm import bpe, exact_dedup, jaccard, mixing, quality
from perigee.llm.common import arrow_rows, fold, materialize, read_table, without
from perigee.llm.registry import vocabulary_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject. It learns from the labels of four folds of ids."""
    at = fold(F.col("doc_id"), 5)
    scored = quality.score_quality(docs, read_table(spark, sf_dir, "labels"), may_learn=at != 0, calibrates=at == 1)
    return without(docs, scored.filter("predicted = 0"), "doc_id", "text")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical documents, the one with the largest id."""
    return exact_dedup.distinct_texts(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the one with the smallest id."""
    return jaccard.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: the words drawn of each document, one row for each round of draws."""
    return mixing.mixed_texts(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with their number and digests of the ids and of the text decoded from them."""
    with arrow_rows(spark, 512):  # whole texts
        return materialize(bpe.encode_digests(docs, vocabulary_path(), with_ids=True), "encoded")


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("mixing", mix),
    ("bpe encoding", encode),
]

#: SQL can't express the learned classifier and the encoder; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
