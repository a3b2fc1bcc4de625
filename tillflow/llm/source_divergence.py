"""Source divergence audit by chunk factorization.

Texts are split at ASCII white space into chunks, with A-Z lower-cased and ASCII characters that
belong to no term stripped from both ends. Workers count chunks per document and add the counts
up by (lang, source, chunk): documents that hold the chunk, and its occurrences. Those rows meet
by chunk, and each globally distinct chunk is tokenized there, once; its terms join its rows.

A language keeps the terms in at least ``least_docs`` of its documents. A document may hold a
term in several chunks, so a term is in at least as many documents as its most frequent chunk and
in at most the sum over its chunks. Terms for which these bounds do not decide have their
documents compared: only for their chunks are documents read again, and distinct ones counted.
The chunks looked for go to the workers if they are at most ``send_chunks`` of 64 bytes each on
average; if more, every chunk of every document is joined with them.

Shares and differences are whole numbers: a group with N occurrences of its language's V kept
terms gives a term with c occurrences p = 1 + floor(10^9 (c + 5) / (N + 5 V)). Differences of
pairs of sources are summed tile by tile: a tile holds a slice of a language's terms and at most
two blocks of its sources, so no task holds all terms or all sources.

Defined results: null text, lang and source count as ''. Every row is a document, repeated ones
too. Groups without terms have shares like all others; a language without kept terms has pairs of
value 0 and no terms. An empty table gives an empty result. Other columns are unused.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillflow.llm.frames import text_of
from tillflow.llm.word_bpe import slices
from tillflow.session import scratch_path

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
OUTSIDE = "".join(chr(c) for c in range(128) if not chr(c).isalpha())
UNIT, EXTRA = 1_000_000_000, 5
BATCH = 32 << 20
# Sources of a block of a tile, and terms of a slice: a tile has at most 2 * 64 * 4096 cells.
SOURCES, TERMS = 64, 4096


class Chunks:
    """The distinct chunks of each text of a batch, and how often they occur in it."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = lists.flatten().dictionary_encode()
        trimmed = pc.ascii_trim(coded.dictionary, OUTSIDE).dictionary_encode()
        self.values = trimmed.dictionary
        code = np.asarray(trimmed.indices)[np.asarray(coded.indices)].astype(np.int64)
        rows = np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))
        pairs, self.times = np.unique(rows * max(1, len(self.values)) + code, return_counts=True)
        self.rows, self.codes = np.divmod(pairs, max(1, len(self.values)))
        empty = pc.equal(self.values, "").to_numpy(zero_copy_only=False)
        some = ~empty[self.codes] if len(pairs) else np.empty(0, bool)
        self.rows, self.codes, self.times = self.rows[some], self.codes[some], self.times[some]


def count_chunks(docs: DataFrame) -> DataFrame:
    """(lang, source, chunk, docs, times) of (lang, source, text), added up within batches."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2, BATCH):
                found = Chunks(batch.column(2))
                lang, source = (batch.column(k).dictionary_encode() for k in (0, 1))
                group = np.asarray(lang.indices).astype(np.int64) * len(source.dictionary)
                group += np.asarray(source.indices)
                n = max(1, len(found.values))
                keys, at = np.unique(group[found.rows] * n + found.codes, return_inverse=True)
                group, code = np.divmod(keys, n)
                of_lang, of_source = np.divmod(group, max(1, len(source.dictionary)))
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(of_lang)),
                     source.dictionary.take(pa.array(of_source)),
                     found.values.take(pa.array(code)),
                     pa.array(np.bincount(at, minlength=len(keys)), pa.int64()),
                     pa.array(np.bincount(at, found.times, len(keys)).astype(np.int64))],
                    ["lang", "source", "chunk", "docs", "times"])

    return docs.select("lang", "source", "text").mapInArrow(
        count, "lang string, source string, chunk string, docs long, times long")


def with_terms(rows: DataFrame) -> DataFrame:
    """Rows of (chunk, ..), sorted by chunk in partitions by chunk, with the terms of each."""
    names = rows.columns

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, terms = None, {}
        for batch in batches:
            chunks = batch.column(names.index("chunk")).dictionary_encode()
            found, sizes = [], []
            for chunk in chunks.dictionary.to_pylist():
                if chunk != last:   # the last chunk of a batch may go on in the next
                    last = chunk
                    terms = {chunk: 1} if chunk.isalpha() else Counter(TERM.findall(chunk))
                found += terms.items()
                sizes.append(len(terms))
            term, n = zip(*found) if found else ((), ())
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(sizes)), pa.int32()),
                pa.StructArray.from_arrays([pa.array(term, pa.string()), pa.array(n, pa.int64())],
                                           ["term", "n"]))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists.take(chunks.indices)],
                                             [*names, "terms"])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema]
    return rows.mapInArrow(tokenize, ", ".join(kinds) + ", terms array<struct<term:string,n:long>>")


def document_chunks(docs: DataFrame, wanted: list[str] | None) -> DataFrame:
    """(lang, doc, chunk) of the ``wanted`` chunks, or of all, distinct in each document."""
    rows = docs.select("lang", F.monotonically_increasing_id().alias("doc"), "text")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = None if wanted is None else pa.array(wanted, pa.string())
        for whole in batches:
            for batch in slices(whole, 2, BATCH):
                found = Chunks(batch.column(2))
                at = np.arange(len(found.rows))
                if chosen is not None:
                    mine = pc.is_in(found.values, value_set=chosen).to_numpy(zero_copy_only=False)
                    at = np.flatnonzero(mine[found.codes]) if len(at) else at
                rows = pa.array(found.rows[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows),
                     found.values.take(pa.array(found.codes[at]))], ["lang", "doc", "chunk"])

    return rows.mapInArrow(find, "lang string, doc long, chunk string")


def kept_terms(docs: DataFrame, counted: DataFrame, least_docs: int,
               send_chunks: int) -> DataFrame:
    """(lang, term) in at least ``least_docs`` documents of the language."""
    spark = docs.sparkSession
    by_chunk = counted.select("lang", "chunk", "docs", F.explode("terms.term").alias("term"))
    bounds = by_chunk.groupBy("lang", "term", "chunk").agg(F.sum("docs").alias("docs")).groupBy(
        "lang", "term").agg(F.max("docs").alias("least"), F.sum("docs").alias("most"))
    folder = scratch_path(spark, "term-bounds")
    bounds.where(F.col("most") >= least_docs).write.parquet(folder)
    bounds = spark.read.parquet(folder)
    sure = bounds.where(F.col("least") >= least_docs).select("lang", "term")
    open_terms = bounds.where(F.col("least") < least_docs).select("lang", "term")
    if open_terms.isEmpty():
        return sure
    folder = scratch_path(spark, "open-chunks")
    counted.select("lang", "chunk", F.explode("terms.term").alias("term")).join(
        open_terms, ["lang", "term"]).distinct().write.parquet(folder)
    chunks = spark.read.parquet(folder)
    names = chunks.select("chunk").distinct()
    n, size = names.agg(F.count(F.lit(1)), F.sum(F.octet_length("chunk"))).first()
    few = n <= send_chunks and size <= 64 * send_chunks
    wanted = [r["chunk"] for r in names.collect()] if few else None
    decided = document_chunks(docs, wanted).join(chunks, ["lang", "chunk"]).select(
        "lang", "term", "doc").distinct().groupBy("lang", "term").count()
    return sure.unionByName(decided.where(F.col("count") >= least_docs).select("lang", "term"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT (count + EXTRA) / (total + EXTRA kept)), in decimals wide enough."""
    wide = "decimal(38,0)"
    top = (count + EXTRA).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", top.cast(wide), (total + EXTRA * kept).cast(wide)) + 1


def pair_sums(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): differences of all pairs of sources, over all kept terms.

    ``cells`` are the (lang, term, source, p) with occurrences; all other shares of a group are
    its ``p0``. A tile sums what its terms add to |p0 - q0|, and the rest is added at the end.
    """
    numbered = groups.withColumn("number", F.row_number().over(
        Window.partitionBy("lang").orderBy("source")) - 1)
    places = numbered.select("lang", "source", "number", "p0", "kept", "sources")
    blocks = F.ceil(F.col("sources") / SOURCES).cast("int")
    own = F.floor(F.col("number") / SOURCES).cast("int")
    entries = cells.join(places, ["lang", "source"]).select(
        "lang", "term", "p", "p0", "number", own.alias("own"),
        F.pmod(F.xxhash64("term"), F.ceil(F.col("kept") / TERMS)).alias("slice"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")).select(
        "lang", "slice", F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"), "term", "number", "p", "p0")
    # Sources of a tile without any of its terms have shares there, too: a row without a term.
    keys = entries.select("lang", "slice", "low", "high").distinct().withColumn(
        "own", F.explode(F.array_distinct(F.array("low", "high"))))
    members = keys.join(places.select("lang", own.alias("own"), "number", "p0"), ["lang", "own"])
    tiles = entries.unionByName(members.select(
        "lang", "slice", "low", "high", F.lit(None).cast("string").alias("term"), "number",
        F.col("p0").alias("p"), "p0"))

    def differences(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, _, low, high = key
        base = rows.groupby("number")["p0"].first()
        numbers = base.index.to_numpy()
        rows = rows[rows["term"].notna()]
        term, terms = pd.factorize(rows["term"])
        shares = np.tile(base.to_numpy(np.int64)[:, None], len(terms))
        shares[np.searchsorted(numbers, rows["number"]), term] = rows["p"]
        found = []
        for k, number in enumerate(numbers):
            if number // SOURCES != low:
                continue
            with_it = numbers // SOURCES == high
            if low == high:
                with_it &= numbers > number
            extra = np.abs(shares[with_it] - shares[k]).sum(axis=1)
            extra -= np.abs(base.to_numpy()[with_it] - base.iloc[k]) * len(terms)
            found.append(pd.DataFrame({"lang": lang, "a": number, "b": numbers[with_it],
                                       "extra": extra}))
        return pd.concat(found) if found else pd.DataFrame(columns=["lang", "a", "b", "extra"])

    extra = tiles.groupBy("lang", "slice", "low", "high").applyInPandas(
        differences, "lang string, a int, b int, extra long").groupBy("lang", "a", "b").agg(
        F.sum("extra").alias("extra"))
    x, y = places.alias("x"), places.alias("y")
    pairs = x.join(y, (F.col("x.lang") == F.col("y.lang"))
                   & (F.col("x.number") != F.col("y.number"))).select(
        F.col("x.lang").alias("lang"), F.col("x.source").alias("source"),
        F.col("y.source").alias("item"), F.least("x.number", "y.number").alias("a"),
        F.greatest("x.number", "y.number").alias("b"),
        (F.abs(F.col("x.p0") - F.col("y.p0")) * F.col("x.kept")).alias("base"))
    return pairs.join(extra, ["lang", "a", "b"], "left").select(
        "lang", "source", "item", (F.col("base") + F.coalesce("extra", F.lit(0))).alias("value"))


def audit_sources(docs: DataFrame, least_docs: int = 30, ranks: int = 50,
                  send_chunks: int = 200_000) -> DataFrame:
    """(lang, source, part, item, value, rank) of documents of (lang, source, text)."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "divergence")
    docs = docs.select(*[text_of(F.col(c)).alias(c) for c in ("lang", "source", "text")])
    added = count_chunks(docs).groupBy("lang", "source", "chunk").agg(
        F.sum("docs").alias("docs"), F.sum("times").alias("times"))
    with_terms(added.repartition("chunk").sortWithinPartitions("chunk")).write.parquet(
        f"{folder}/chunks")
    counted = spark.read.parquet(f"{folder}/chunks")
    kept_terms(docs, counted, least_docs, send_chunks).write.parquet(f"{folder}/kept")
    kept = spark.read.parquet(f"{folder}/kept")

    occurring = counted.select("lang", "source", "times", F.explode("terms").alias("t")).select(
        "lang", "source", F.col("t.term").alias("term"), (F.col("times") * F.col("t.n")).alias("c"))
    occurring.join(kept, ["lang", "term"]).groupBy("lang", "term", "source").agg(
        F.sum("c").alias("c")).write.parquet(f"{folder}/cells")
    cells = spark.read.parquet(f"{folder}/cells")

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = cells.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    found = docs.select("lang", "source").distinct()
    p0 = F.when(F.col("kept") > 0, share(F.lit(0), F.col("n"), F.col("kept"))).otherwise(F.lit(0))
    groups = found.join(sizes, "lang", "left").join(totals, ["lang", "source"], "left").join(
        found.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")), "lang").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("kept", "n")}).withColumn("p0", p0)
    groups.write.parquet(f"{folder}/groups")
    groups = spark.read.parquet(f"{folder}/groups")

    shares = cells.join(groups.select("lang", "source", "n", "kept"), ["lang", "source"]).select(
        "lang", "term", "source", share(F.col("c"), F.col("n"), F.col("kept")).alias("p"))
    in_lang = groups.groupBy("lang").agg(F.sum("n").alias("n"), F.first("kept").alias("kept"))
    of_lang = cells.groupBy("lang", "term").agg(F.sum("c").alias("c")).join(in_lang, "lang").select(
        "lang", "term", share(F.col("c"), F.col("n"), F.col("kept")).alias("q"))
    terms = shares.join(of_lang, ["lang", "term"]).where(F.col("p") > F.col("q")).select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                           F.row_number().over(best).alias("rank"))

    return ranked(pair_sums(shares, groups), "pair").unionByName(
        ranked(terms, "term").where(F.col("rank") <= ranks))
