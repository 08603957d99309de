"""From documents to packed training sequences: five of the corpus operators, one after another.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.  All but the last
return the columns of documents.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from batchgate.llm import decontaminate, line_dedup, near_dedup, packing, toxicity  # noqa: E402
from batchgate.llm.common import ship, stage, table  # noqa: E402


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go."""
    ship(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of passages of three or more lines are cut from the texts; texts that lose all go."""
    ship(spark)
    cut = line_dedup.drop_repeated_lines(docs)
    cut = cut.where(~((F.col("removed_lines") > 0) & (F.col("removed_lines") == F.col("n_lines"))))
    n_chars = F.when(F.col("removed_parts") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates stays."""
    ship(spark)
    return near_dedup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    ship(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    ship(spark)
    # Workers still hold what earlier stages took, so this one remembers less than it does alone.
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), remembered=100_000, special_tokens=True)


STAGES = [
    ("toxicity", toxic),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark),
    ("packing", pack),
]

# Classifiers, sketches and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents, each one's rows staged for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
