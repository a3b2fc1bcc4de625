"""The registered queries of the corpus operators, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillflow.llm import (
    bin_packing, chat_parts, curve_packing, fp_search, line_crf, line_dedup, near_dups,
    order_minhash, source_divergence, topk_nra, toxicity_fm, warc, word_bpe,
)
from tillflow.llm.labelled import remainder
from tillflow.llm.twins import ORACLES
from tillflow.session import scratch_path, shared_folder

__all__ = ["ORACLES", "QUERIES"]

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
QUALITY_THRESHOLD, TOXICITY_THRESHOLD = 0.3, 0.7
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.dedup_lines(docs)
    return done.select("doc_id", "n_lines", "n_dropped",
                       F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.archive_pages(spark, pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = word_bpe.code_texts(docs, VOCABULARY, decode=True, keep=["doc_id"])
    written = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(written, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bin_packing.pack_documents(docs, VOCABULARY)


def _classified(spark: SparkSession, sf_dir: str, module, modulus: int, held: int,
                threshold: float) -> DataFrame:
    shared_folder(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = remainder("doc_id", modulus)
    model = module.fit(docs, table(spark, sf_dir, "labels"), fold != held)
    scored = module.score_texts(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (fold == held).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


@query
def op3_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, line_crf, 5, 0, QUALITY_THRESHOLD)


@query
def op10_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, toxicity_fm, 3, 1, TOXICITY_THRESHOLD)


@query
def op5_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dups.near_duplicates(docs, percent=85)


@query
def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return order_minhash.fingerprints(docs).select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next")


@query
def op6_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", trap), (-1, 1, "assistant", trap)],
        "conv_id long, turn long, role string, text string")
    folder = scratch_path(spark, "chat")
    chat_parts.format_turns(turns.unionByName(extra)).write.parquet(folder)
    return chat_parts.read_digests(spark.read.parquet(folder))


@query
def op7_topk_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk_nra.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "source", "text")
    return source_divergence.audit_sources(docs, least_docs=30, ranks=50)


@query
def op12_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return curve_packing.pack_along_curve(docs, VOCABULARY)


@query
def op13_fp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return fp_search.rank_documents(docs, items)
