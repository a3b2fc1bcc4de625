"""Bounded samples of labelled documents, for fitting the classifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; the folds of the classifiers."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, fit_on: Column,
                  per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(label, text) of at most ``per_class`` documents of each label, drawn by a hash of the id.

    Only the labels are sorted; the drawn ids, at most twice ``per_class``, meet the documents in
    one scan. Of the rows that share an id one is taken, that whose text has the least hash, so
    the bound holds for rows, too; the others are let go before anything is shuffled.
    """
    known = labels.where(fit_on & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct()
    drawn = [known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_class)
             for label in (0, 1)]
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    met = texts.join(reduce(DataFrame.unionByName, drawn), "id")
    order = F.struct(F.xxhash64("text"), "text")
    return met.groupBy("id", "label").agg(F.min_by("text", order).alias("text")).select(
        "label", "text")
