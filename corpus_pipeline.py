"""A corpus from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the
one before kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import lines, mixing, near, packing, quality
from carelake.llm.common import shared_folder, table
from carelake.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.select_documents(docs, table(spark, sf_dir, "labels"), train_on=table(spark, sf_dir, "documents"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that match an earlier one; what loses every line goes with the next stage."""
    return lines.remove_lines(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it whole."""
    return mixing.repeat_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 1024 tokens."""
    return packing.pack_documents(docs, tokenizer_path()).drop("loss_tokens")


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("mixing", mix_sources),
    ("packing", pack),
]
# Trained weights, sampled hashes and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and reread."""
    folder = posixpath.join(shared_folder(spark), f"corpus-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
