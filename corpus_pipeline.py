"""A training corpus out of ``documents``, stage by stage.

Every stage works on all that the one before kept; its result is written as
Parquet and read again by the next one. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalmart.llm import language_id, minmax_dedup, mixing, packing, substring_dedup
from vitalmart.llm.common import freed, removed, table
from vitalmart.llm.queries import tokenizer_path
from vitalmart.session import warehouse_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without letters or a likely language go."""
    return language_id.known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Min-max hashing: of documents alike (five-word shingles, 0.8) one stays."""
    return minmax_dedup.one_of_each(docs, shingle=5, percent=80)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines and sentences go from the texts, but for the earliest."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    done = substring_dedup.without_repeats(rows)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return done.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    return mixing.sampled(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.packed(docs, tokenizer_path())


STAGES = [("language", language), ("near_dedup", near_dedup), ("substring", substring), ("mix", mix), ("pack", pack)]

#: The stages are a trained model, a tokenizer and a packing plan: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    last = None
    for name, stage in STAGES:
        path = warehouse_path(spark, "pipeline", f"{uuid.uuid4().hex}-{name}")
        with freed(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            removed(spark, last)
        last = path
    return docs  # its table stays in the shared folder
