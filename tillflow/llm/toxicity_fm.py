"""Toxicity by a factorization machine over hashed terms.

The terms (runs of word characters, lower-cased) of a text are hashed into buckets; a text is
the set of its buckets. The score is the logistic of bias + sum of w_i + sum over pairs of
<v_i, v_j>. The pairwise part learns combinations, such as an insult together with the mention
of a group, that weights of single terms miss.

Fitting: document frequencies of the buckets are counted with Spark over a drawn sample of at
most ``per_class`` labelled rows of each class. Two kinds of buckets keep a weight: the ``terms``
whose frequencies differ most between the classes, and those of the ``pairs`` pairs whose
covariance differs most, and by over LEAST_SCORE standard errors, between the classes. Pairs are
looked for among the ``frequent`` most frequent buckets, so a combination counts even where its
members alone say nothing. The sample's vectors over these buckets are fitted on the driver: at
most 2 * per_class * (terms + frequent) cells.

Defined results: null and empty texts have no terms and get the score of the bias. If a class
has no row to learn from, every score is 0.5. Rows are scored one by one, repeated ones alike.
Other columns stay; one named like an added column is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillflow.llm.labelled import training_rows
from tillflow.llm.word_bpe import slices

BUCKETS = 1 << 20
# Of half a million pairs without any effect, none is expected beyond this many standard errors.
LEAST_SCORE = 6.0
WORD = re.compile(r"\w+")
_known: dict[str, int] = {}


def term_buckets(text: str | None) -> set[int]:
    """The buckets of a text's terms."""
    found = set()
    for word in set(WORD.findall((text or "").lower())):
        bucket = _known.get(word)
        if bucket is None:
            if len(_known) > 300_000:
                _known.clear()
            bucket = _known[word] = zlib.crc32(word.encode()) % BUCKETS
        found.add(bucket)
    return found


def bucket_rows(rows: DataFrame) -> DataFrame:
    """(label, buckets) of (label, text)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                sets = [sorted(term_buckets(t)) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sets, pa.list_(pa.int32()))], ["label", "buckets"])

    return rows.select("label", "text").mapInArrow(hashed, "label int, buckets array<int>")


@dataclass
class FactorizationMachine:
    buckets: np.ndarray  # sorted
    bias: float
    weights: np.ndarray
    factors: np.ndarray  # (terms, rank)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Of rows of zeros and ones over the buckets."""
        pairs = (x @ self.factors) ** 2 - x @ self.factors ** 2
        return self.bias + x @ self.weights + 0.5 * pairs.sum(axis=1)

    def score(self, sets: list[set[int]]) -> np.ndarray:
        """Probabilities of texts given as their buckets, all in flat arrays."""
        place = np.full(BUCKETS, -1, np.int32)
        place[self.buckets] = np.arange(len(self.buckets))
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        flat = np.fromiter((b for s in sets for b in s), np.int64, sizes.sum())
        at, row = place[flat], np.repeat(np.arange(len(sets)), sizes)
        at, row = at[at >= 0], row[at >= 0]
        add = lambda values: np.bincount(row, values, len(sets))
        z = self.bias + add(self.weights[at])
        for v in self.factors.T:
            z += 0.5 * (add(v[at]) ** 2 - add(v[at] ** 2))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def telling_pairs(x: np.ndarray, y: np.ndarray, pairs: int) -> np.ndarray:
    """Columns of the pairs whose covariance differs most between the classes."""
    covariance, error = 0.0, 0.0
    for label, sign in ((1, 1.0), (0, -1.0)):
        rows = x[y == label]
        mean = rows.mean(axis=0)
        covariance = covariance + sign * (rows.T @ rows / len(rows) - np.outer(mean, mean))
        spread = mean * (1 - mean)
        # At least the error of a single row, so that rare pairs do not seem certain.
        error = error + (np.outer(spread, spread) + 1 / len(rows)) / len(rows)
    score = np.triu(np.abs(covariance) / np.sqrt(error), 1)
    flat = score.ravel()
    best = np.argsort(-flat, kind="stable")[:pairs]
    best = best[flat[best] > LEAST_SCORE]
    return np.unique(np.concatenate(np.unravel_index(best, score.shape)))


def train(x: np.ndarray, y: np.ndarray, rank: int = 8, steps: int = 250, rate: float = 0.05,
          decay: float = 1e-5, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors of the logistic loss, by Adam; both classes weigh the same."""
    rng = np.random.default_rng(seed)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    share = share.astype(np.float32)
    params = [np.zeros(1, np.float32), np.zeros(x.shape[1], np.float32),
              rng.normal(0, 0.01, (x.shape[1], rank)).astype(np.float32)]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        bias, w, v = params
        xv = x @ v
        z = bias[0] + x @ w + 0.5 * (xv ** 2 - x @ v ** 2).sum(axis=1)
        error = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        xe = x.T @ error
        grads = [np.array([error.sum()], np.float32), xe + decay * w,
                 x.T @ (error[:, None] * xv) - xe[:, None] * v + decay * v]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] = params[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return float(params[0][0]), params[1], params[2]


def fit(docs: DataFrame, labels: DataFrame, fit_on: Column, label_col: str = "toxic",
        per_class: int = 4000, terms: int = 512, rank: int = 8, frequent: int = 1024,
        pairs: int = 128) -> FactorizationMachine | None:
    """Learn from the labelled rows where ``fit_on``; None if a class has none."""
    sample = bucket_rows(training_rows(docs, labels, label_col, fit_on, per_class)).checkpoint()
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return None
    n = {k: float(sizes[k]) for k in (0, 1)}
    seen = sample.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        *[F.sum((F.col("label") == k).cast("long")).alias(f"df{k}") for k in (0, 1)])
    p = (F.col("df0") + F.col("df1") + 1) / (n[0] + n[1] + 2)
    contrast = (F.col("df1") / n[1] - F.col("df0") / n[0]) / F.sqrt(
        p * (1 - p) * (1 / n[0] + 1 / n[1]))

    def first(order: Column, limit: int) -> np.ndarray:
        rows = seen.orderBy(order.desc(), "bucket").limit(limit).select("bucket").collect()
        return np.array(sorted(r["bucket"] for r in rows), np.int64)

    alone, common = first(F.abs(contrast), terms), first(p, frequent)
    known = np.union1d(alone, common)
    kept = F.array_intersect("buckets", F.lit(known.tolist()).cast("array<int>"))
    rows = sample.select("label", F.array_sort(kept).alias("buckets")).toArrow()
    y = rows.column("label").to_numpy()
    lists = rows.column("buckets").combine_chunks()
    x = np.zeros((len(y), len(known)), np.float32)
    size = np.diff(np.asarray(lists.offsets))
    x[np.repeat(np.arange(len(y)), size), np.searchsorted(known, lists.flatten())] = 1
    # Sums of floats depend on the order of the rows, which the scan does not fix.
    order = np.lexsort([*np.packbits(x.astype(bool), axis=1).T, y])
    x, y = x[order], y[order]
    of_pairs = telling_pairs(x[:, np.isin(known, common)], y, pairs)
    buckets = np.union1d(alone, common[of_pairs])
    bias, w, v = train(x[:, np.isin(known, buckets)], y, rank)
    return FactorizationMachine(buckets, bias, w, v)


def score_texts(docs: DataFrame, model: FactorizationMachine | None, text_col: str = "text",
                name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Adds the score of every text; ``keep`` names the input columns to return."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != name]
    columns = [*kept, text_col] if text_col not in kept else kept
    source, text = docs.select(*columns), columns.index(text_col)
    schema = T.StructType([docs.schema[c] for c in kept]).add(name, T.DoubleType(), False)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                texts = batch.column(text).to_pylist()
                scores = (np.full(len(texts), 0.5) if model is None
                          else model.score([term_buckets(t) for t in texts]))
                out = {c: batch.column(k) for k, c in enumerate(kept)}
                yield pa.RecordBatch.from_pydict(out | {name: pa.array(scores, pa.float64())})

    return source.mapInArrow(score, schema)
