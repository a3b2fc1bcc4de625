"""Ranked lexical search by branch and bound over trees of frequency-ordered document vectors.

Each document is restricted to the terms of the items (the queries) and becomes a vector of terms
with their counts, the most frequent term of the corpus first. The vectors of a block of
documents, sorted, form a trie in which common beginnings share a path; paths without a branch
are drawn together, and small neighbouring branches are kept as leaves of at most ``LEAF``
documents. Every node holds, over the documents below it, the maximum of each term's count and
the minimum of m, the length term of the score. As the score grows with the counts and falls with
m, these give an upper bound. Each item walks the tree depth first, the better child first, and
leaves out what cannot reach its ``k``-th best score so far; a leaf is scored whole.

Scores are whole numbers: with N documents that have a term, L terms in them, df documents with
a term and tf of its occurrences in a document of n terms, ``weight`` is
floor(1000 ln((2 N + 2) / (2 df + 1))), m is 25 + (75 n N) div L, and a document scores the sum
of weight * ((10^9 tf) div (1000 tf + 8 m)) over the item's terms, repeats included.

The corpus counts cover all documents. Items are taken in blocks of at most ``block_items`` and
about ``block_bytes`` of text; for each, the documents are read once, their vectors are written to
the shared folder, and the terms of a block, their counts and weights go to the tasks.

Defined results: null texts have no terms. Documents without an id count and rank, after others
of the same score. Items without an id, with equal ids or without terms are answered one by one:
rows that repeat an item's id and text give one answer, of different texts with one id each its
own. Repeated documents rank one by one. Empty tables give an empty result. Other columns are
unused.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillflow.llm.word_bpe import slices
from tillflow.session import scratch_path

# Documents of a tree and of a leaf at most, and about how many maxima a tree holds.
BLOCK, LEAF, CELLS = 10_000, 48, 1 << 24
VECTOR = "doc_id long, n long, terms array<int>, counts array<int>"
# Term characters are 0-9, letters and all beyond ASCII; A-Z are lower-cased, others separate.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32
                   for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TERM_BYTES).split() if text else []


def term_vectors(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """VECTOR of every document with a term: its terms among ``numbers``, by their numbers."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("binary").alias("text"))

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.get
        for whole in batches:
            for batch in slices(whole, 1):
                found = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words = terms_of(text)
                    if words:
                        counts = Counter(map(number, words))
                        counts.pop(None, None)
                        found.append((doc_id, len(words), list(counts), list(counts.values())))
                if found:
                    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), kinds)],
                        ["doc_id", "n", "terms", "counts"])

    return rows.mapInArrow(restrict, VECTOR)


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class DocumentTree:
    """A block of vectors as a trie with maxima of counts and minima of m.

    ``rows``, ``ranks`` and ``counts`` are the entries: the document's place, the term's rank by
    frequency and its count; ``m`` is by document and ``terms`` the number of ranks.
    """

    def __init__(self, rows: np.ndarray, ranks: np.ndarray, counts: np.ndarray, m: np.ndarray,
                 terms: int):
        order = np.lexsort((ranks, rows))
        rows, ranks, counts = rows[order], ranks[order], counts[order]
        edges = np.searchsorted(rows, np.arange(len(m) + 1))
        paths = [ranks[a:b] for a, b in itertools.pairwise(edges.tolist())]
        # Big-endian bytes compare like the ranks themselves.
        keys = [p.astype(">u4").tobytes() for p in paths]
        self.documents = np.array(sorted(range(len(m)), key=keys.__getitem__), np.int64)
        self.m = m[self.documents]
        self.shared = [0] + [_shared(paths[a], paths[b])
                             for a, b in itertools.pairwise(self.documents.tolist())]
        at = np.concatenate([np.arange(edges[d], edges[d + 1]) for d in self.documents])
        self.edges = np.append(0, np.cumsum(np.diff(edges)[self.documents]))
        self.ranks, self.counts = ranks[at], counts[at].astype(np.int64)
        self.gains = gain(self.counts, np.repeat(self.m, np.diff(self.edges)))
        self.terms = terms
        self.spans: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self._grow()

    def _grow(self) -> None:
        """The nodes, parents first: spans of sorted documents, split where paths part."""
        shared = np.array(self.shared)
        self.spans.append((0, len(self.m)))
        for node in itertools.count():
            if node == len(self.spans):
                break
            a, b = self.spans[node]
            self.children.append([])
            if b - a <= LEAF:
                continue
            inner = shared[a + 1:b]
            parts = [a, *(a + 1 + np.flatnonzero(inner == inner.min())).tolist(), b]
            begun = a
            for start, end in itertools.pairwise(parts):
                # Small neighbours go together; a large branch stands alone.
                if start > begun and end - begun > LEAF:
                    self._child(node, begun, start)
                    begun = start
                if end - begun > LEAF:
                    self._child(node, begun, end)
                    begun = end
            if begun < b:
                self._child(node, begun, b)
        self.largest = np.zeros((len(self.spans), self.terms), np.int32)
        self.least = np.zeros(len(self.spans), np.int64)
        for node in range(len(self.spans) - 1, -1, -1):
            a, b = self.spans[node]
            self.least[node] = self.m[a:b].min()
            if self.children[node]:
                self.largest[node] = self.largest[self.children[node]].max(axis=0)
            else:
                e, f = self.edges[a], self.edges[b]
                np.maximum.at(self.largest[node], self.ranks[e:f], self.counts[e:f])

    def _child(self, node: int, a: int, b: int) -> None:
        self.children[node].append(len(self.spans))
        self.spans.append((a, b))

    def bounds(self, nodes: list[int], ranks: np.ndarray, weights: np.ndarray) -> np.ndarray:
        largest = self.largest[np.ix_(nodes, ranks)].astype(np.int64)
        return (weights * gain(largest, self.least[nodes][:, None])).sum(axis=1)

    def search(self, ranks: np.ndarray, weights: np.ndarray, ids: list, found: Counted) -> int:
        """Offer what may be among the k best, by its id; returns the leaves scored."""
        leaves = 0
        weight = np.zeros(self.terms, np.int64)
        weight[ranks] = weights
        stack = [(int(self.bounds([0], ranks, weights)[0]), 0)]
        while stack:
            bound, node = stack.pop()
            if bound < found.floor:
                continue
            if self.children[node]:
                nodes = self.children[node]
                bounds = self.bounds(nodes, ranks, weights)
                stack += sorted(zip(bounds.tolist(), nodes))
                continue
            leaves += 1
            a, b = self.spans[node]
            e, f = self.edges[a], self.edges[b]
            total = np.append(0, np.cumsum(weight[self.ranks[e:f]] * self.gains[e:f]))
            scores = np.diff(total[self.edges[a:b + 1] - e])
            for k in np.flatnonzero(scores >= found.floor).tolist():
                found.offer(int(scores[k]), ids[self.documents[a + k]])
        return leaves


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    return int(differ[0]) if len(differ) else n


class Counted:
    """The k best (score, id) of an item; of equal scores the smaller id, nulls last."""

    def __init__(self, k: int):
        self.k, self.heap, self.floor = k, [], 1

    def offer(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, 0 if doc_id is None else -doc_id)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        else:
            heapq.heappushpop(self.heap, entry)
        if len(self.heap) == self.k:
            self.floor = self.heap[0][0]

    def best(self) -> list[tuple[int | None, int]]:
        return [(-i if known else None, score) for score, known, i in self.heap]


def search_block(docs: DataFrame, items: list[tuple[int | None, Counter]], k: int) -> DataFrame:
    """(item, doc_id, score): for each task the k best documents of each item, or more tasks'."""
    spark = docs.sparkSession
    numbers = {t: n for n, t in enumerate(sorted(set().union(*(c for _, c in items))))}
    folder = scratch_path(spark, "search-vectors")
    term_vectors(docs, numbers).write.parquet(folder)
    vectors = spark.read.parquet(folder)
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(numbers), np.int64)
    # At most one row for each term of the block's items.
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row["term"]] = row["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1)))
                       for d in df], np.int64)
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
    asked = []
    for number, (_, counts) in enumerate(items):
        at = np.array([numbers[t] for t in counts], np.int64)
        asked.append((number, rank[at], weight[at] * np.array(list(counts.values()), np.int64)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [Counted(k) for _ in asked]
        size = min(BLOCK, max(LEAF, LEAF * CELLS // (4 * len(rank))))
        for whole in batches:
            for a in range(0, whole.num_rows, size):
                batch = whole.slice(a, size)
                terms, counts = batch.column(2), batch.column(3)
                sizes = np.diff(np.asarray(terms.offsets))
                m = 25 + 75 * np.asarray(batch.column(1)) * n_docs // n_terms
                tree = DocumentTree(
                    np.repeat(np.arange(len(sizes)), sizes), rank[np.asarray(terms.flatten())],
                    np.asarray(counts.flatten()), m, len(rank))
                ids = batch.column(0).to_pylist()
                for (_, ranks, weights), best in zip(asked, kept):
                    tree.search(ranks, weights, ids, best)
        rows = [(number, *pair) for (number, _, _), best in zip(asked, kept)
                for pair in best.best()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)], ["item", "doc_id", "score"])

    return vectors.mapInArrow(search, "item long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, block_items: int = 256,
                   block_bytes: int = 4 << 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of (doc_id, text) for each item."""
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    n, size = asked.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-n // block_items), -(-(size or 0) // block_bytes))
    parts = []
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        rows = asked.where(mine).select("item_id", F.col("text").cast("binary")).collect()
        counted = [(r[0], Counter(terms_of(r[1]))) for r in rows]
        counted = [(i, c) for i, c in counted if c]
        if not counted:
            continue
        names = spark.createDataFrame(
            [(number, i) for number, (i, _) in enumerate(counted)], "item long, item_id long")
        best = Window.partitionBy("item").orderBy(
            F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = search_block(docs, counted, k).withColumn("rank", F.row_number().over(best))
        parts.append(ranked.where(F.col("rank") <= k).join(names, "item").select(
            "item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)
