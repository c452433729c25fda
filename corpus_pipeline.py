"""Corpus pipeline: each stage is one operator of `showledger.llm`, applied to what the stage before it kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns of `documents`. Null texts
count as empty; an empty input passes through as an empty one; rows that repeat entirely are one document after the
exact stage; extra columns of the documents are carried along.
"""

from __future__ import annotations

import os
import sys
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from showledger.llm import byte_bpe, exact_dedup, jaccard_join, toxicity, winnowing  # noqa: E402
from showledger.llm.common import read  # noqa: E402
from showledger.session import shared_dir, adopt  # noqa: E402


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    adopt(spark)
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays: the one with the smallest doc_id."""
    adopt(spark)
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the one with the smallest doc_id."""
    adopt(spark)
    return jaccard_join.drop_near(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    adopt(spark)
    return winnowing.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left (little-endian unsigned 32-bit), checked by decoding them."""
    adopt(spark)
    coder = byte_bpe.ByteBPE(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    done = coder.encode(docs.select("doc_id", "text", "lang", "source"))
    same = F.col("raw") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return done.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("decontamination", benchmark_stage),
    ("byte_bpe", token_stage),
]

#: The toxicity model has no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written to the shared folder and read again by the next."""
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
