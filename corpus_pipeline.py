"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemerge.llm import mixing, packing, pii, quality, simhash
from tidemerge.llm.common import shared_folder, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from ``labels`` of the documents given. Without any, all score one half and none is good."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that of smallest id. Rows count by their own text, so rows that repeat an id with other texts are documents of their own."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by marks; null texts stay null, repeated rows are masked alike."""
    return pii.mask_personal_data(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as smoothed language weights ask; none is left out, rare languages repeat. The labelled table: languages of documents in ``labels``, without which each document stays once."""
    return mixing.mix(docs, languages(spark, docs, sf_dir), power=0.7, least=1.0)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(seen, "doc_id", "left_semi")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document in a sequence of a permitted length; a null or empty text is its end mark alone, repeated rows are packed each."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each_group),
    ("PII", without_personal_data),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

#: SQL expresses no stage that a trained model decides; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of ``documents``.

    Each stage takes any rows: null texts and ids, repeated rows, ties and further columns as its
    operator states; an empty table gives an empty corpus. What the stages write stays in a folder
    of its own under the shared one, for its owner to remove.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
