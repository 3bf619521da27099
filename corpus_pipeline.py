"""Corpus pipeline over ``documents``: stages applied one after the other, each to all that its predecessor kept.

All stages but the last return the columns of ``documents``.  No SQL states the trained, hashed and tokenized steps;
the stages are tested against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.llm import exact_dedup, minhash, mixing, pieces, toxicity
from codesieve.llm.queries import TOXIC_FROM, toxicity_machine


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator predicts as toxic go."""
    return toxicity.without_toxic(docs, toxicity_machine(spark, docs, sf_dir), TOXIC_FROM)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates, the document with the smallest doc_id of each group stays."""
    return minhash.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mixture: part files and their rows follow its slots."""
    return mixing.mixed_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded text."""
    rows = pieces.encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", clean),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing sources", mixed),
    ("SentencePiece", encoded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
