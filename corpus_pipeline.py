"""Corpus pipeline over documents: two filters, two dedups, packing.

Each stage works on all that its predecessor kept and all but the last return the columns of
documents. The classifiers learn from ``labels`` of the documents that reach them, leaving out
the same folds as the registered queries. Null texts count as empty throughout; an empty table
passes all stages as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillflow.llm import bin_packing, line_crf, line_dedup, near_dups, toxicity_fm
from tillflow.llm.labelled import remainder
from tillflow.session import scratch_path, shared_folder

TOXIC, GOOD = 0.7, 0.3
SCORE = "pipeline score"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of TOXIC or more go."""
    shared_folder(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity_fm.fit(docs, labels, remainder("doc_id", 3) != 1)
    scored = toxicity_fm.score_texts(docs, model, name=SCORE)
    return scored.where(F.col(SCORE) < TOXIC).select(docs.columns)


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality under GOOD go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = line_crf.fit(docs, labels, remainder("doc_id", 5) != 0)
    scored = line_crf.score_texts(docs, model, name=SCORE)
    return scored.where(F.col(SCORE) >= GOOD).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; every document keeps its row, and n_chars follows the text."""
    return line_dedup.cleaned(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, one row of it."""
    return near_dups.without_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences of 2048 tokens."""
    return bin_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("quality", reject_poor),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_documents),
    ("packing", pack),
]

# Models, merges and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
