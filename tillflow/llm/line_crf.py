"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its potential is linear in features of the line and of the lines
before and after it; a table of transitions links neighbours. Forward-backward gives the
marginal of every line, and the score of a document is the mean of the marginals of "good",
weighted by line length in bytes. All lines of a batch are handled in flat arrays: features by
sums over byte classes, the chain by steps that take the next line of every document at once.

Fitting: at most ``per_class`` labelled documents of each class, drawn by a hash of the id; the
lines of a document carry its label. Documents are cut into chains of at most ``CHAIN`` lines.
The features of at most ``chains`` chains go to the driver: first one of each document, then
others, all drawn by hash, so the driver holds ``chains * CHAIN`` lines at most.

Defined results: null and empty texts are one empty line and get its score. If a class has no
row to learn from, every score is 0.5. Repeated rows score alike. Other columns stay; one named
like an added column is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, types as T

from tillflow.llm.labelled import training_rows
from tillflow.llm.word_bpe import slices

CHAIN = 200
SPACE, LETTER, CAPITAL, DIGIT, POINT, SYMBOL, LEAD, TAIL = range(8)


def _byte_classes() -> np.ndarray:
    kind = np.full(256, SYMBOL, np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = SPACE
    kind[np.arange(ord("a"), ord("z") + 1)] = LETTER
    kind[np.arange(ord("A"), ord("Z") + 1)] = CAPITAL
    kind[np.arange(ord("0"), ord("9") + 1)] = DIGIT
    kind[[ord(c) for c in ".,;:'\"()-?"]] = POINT
    kind[0x80:0xC0], kind[0xC0:] = TAIL, LEAD
    return kind


KIND = _byte_classes()
_random = np.random.default_rng(11)
BYTE_CODE = _random.integers(1, 1 << 62, 256, dtype=np.uint64)
PLACE_CODE = _random.integers(1, 1 << 62, 64, dtype=np.uint64) | np.uint64(1)


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return (total[edges[1:]] - total[edges[:-1]]).astype(np.float64)


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes of each line, lines of each text) of all lines of the texts in order."""
    raw = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    ends = np.flatnonzero(raw == 10)
    edges = np.append(0, ends + 1)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    lines = np.diff(np.append(0, np.searchsorted(ends, text_ends - 1) + 1))
    size = np.diff(edges) - 1

    kind = KIND[raw]
    count = [_sums(kind == k, edges) for k in range(8)]
    inside = kind != SPACE
    begins = np.flatnonzero(inside & np.append(True, ~inside[:-1]))
    line_of = np.searchsorted(ends, begins)
    words = np.bincount(line_of, minlength=len(size)).astype(np.float64)
    repeats = np.zeros(len(size))
    if len(begins):
        at = np.flatnonzero(inside)
        which = np.searchsorted(begins, at, side="right") - 1
        place = np.minimum(at - begins[which], 63)
        starts = np.searchsorted(at, begins)
        code = np.add.reduceat(BYTE_CODE[raw[at]] * PLACE_CODE[place], starts)
        again = (code[1:] == code[:-1]) & (line_of[1:] == line_of[:-1])
        repeats = np.bincount(line_of[1:][again], minlength=len(size)).astype(np.float64)

    letters = count[LETTER] + count[CAPITAL] + count[LEAD]
    some, word = np.maximum(letters, 1), np.maximum(words, 1)
    own = np.column_stack([
        np.log1p(size) / 8, letters / np.maximum(size - count[TAIL], 1),
        count[CAPITAL] / some, count[SYMBOL] / word, count[POINT] / word, count[DIGIT] / word,
        np.minimum(some / word, 20) / 10, repeats / word, (repeats > 2).astype(float),
        (count[SYMBOL] > 0.3 * word).astype(float), (count[CAPITAL] > 0.5 * some).astype(float),
        (size <= 0).astype(float)])
    first = np.zeros(len(size), bool)
    first[np.cumsum(lines) - lines] = True
    last = np.append(first[1:], True)[:len(size)]
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    features = np.column_stack([np.ones(len(size)), own, before, after, first, last])
    return features, np.maximum(size, 1), lines


@dataclass
class LineCrf:
    weights: np.ndarray      # log-odds of good, by feature
    transitions: np.ndarray  # (from, to), 0 bad and 1 good


def marginals(odds: np.ndarray, lines: np.ndarray, transitions: np.ndarray):
    """Forward-backward over all chains at once.

    ``odds`` are log-odds of good of all lines in order, ``lines`` the length of each chain.
    Returns the marginals of good, the expected transitions and the log partition sum.
    """
    order = np.argsort(-lines, kind="stable")
    start, length = (np.cumsum(lines) - lines)[order], lines[order]
    local = np.empty((len(odds), 2))
    local[:, 1] = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    local[:, 0] = 1 - local[:, 1]
    move = np.exp(transitions)
    alpha, scale = np.empty_like(local), np.empty(len(odds))
    beta = np.ones_like(local)
    expected = np.zeros((2, 2))
    longest = int(length[0]) if len(length) else 0
    active = [np.searchsorted(-length, -t, side="left") for t in range(longest)]
    for t in range(longest):
        at = start[:active[t]] + t
        value = local[at] if t == 0 else local[at] * (alpha[at - 1] @ move)
        scale[at] = value.sum(axis=1)
        alpha[at] = value / scale[at][:, None]
    for t in range(longest - 1, 0, -1):
        at = start[:active[t]] + t
        ahead = local[at] * beta[at] / scale[at][:, None]
        expected += move * (alpha[at - 1].T @ ahead)
        beta[at - 1] = ahead @ move.T
    good = alpha[:, 1] * beta[:, 1]
    # local holds each line's potentials divided by their sum.
    partition = np.log(scale).sum() + np.logaddexp(0, np.clip(odds, -30, 30)).sum()
    return good, expected, partition


def train(features: np.ndarray, lines: np.ndarray, labels: np.ndarray, steps: int = 150,
          rate: float = 0.1, decay: float = 1e-3) -> LineCrf:
    """Maximum likelihood by Adam; every line has its document's label."""
    truth = np.repeat(labels, lines).astype(float)
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = (lines[labels == label] - 1).sum()
    weights, transitions = np.zeros(features.shape[1]), np.zeros((2, 2))
    params, n = [weights, transitions], len(truth)
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        good, expected, _ = marginals(features @ params[0], lines, params[1])
        grads = [features.T @ (good - truth) / n + decay * params[0],
                 (expected - seen) / n + decay * params[1]]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] = params[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return LineCrf(*params)


def score_bytes(model: LineCrf | None, texts: list[bytes]) -> np.ndarray:
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    features, size, lines = line_features(texts)
    good, _, _ = marginals(features @ model.weights, lines, model.transitions)
    starts = np.cumsum(lines) - lines
    mean = np.add.reduceat(good * size, starts) / np.add.reduceat(size, starts)
    return np.clip(mean, 0, 1)


def texts_of(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def feature_rows(rows: DataFrame) -> DataFrame:
    """(label, lines, features, further, draw) of (label, text): float32 rows of each chain.

    ``further`` is 0 for one chain of each text and 1 for the others, ``draw`` a hash.
    """

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                texts = texts_of(batch.column(1))
                features, _, lines = line_features(texts)
                at, found = 0, []
                for label, text, n in zip(batch.column(0).to_pylist(), texts, lines.tolist()):
                    code, parts = zlib.crc32(text), -(-n // CHAIN)
                    for part in range(parts):
                        a = at + part * CHAIN
                        chain = features[a:min(a + CHAIN, at + n)].astype(np.float32)
                        found.append((label, len(chain), chain.tobytes(),
                                      int(part != code % parts),
                                      zlib.crc32(part.to_bytes(8, "little"), code)))
                    at += n
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), kinds)],
                    ["label", "lines", "features", "further", "draw"])

    return rows.select("label", "text").mapInArrow(
        chains, "label int, lines int, features binary, further int, draw long")


def fit(docs: DataFrame, labels: DataFrame, fit_on: Column, label_col: str = "quality",
        per_class: int = 1500, chains: int = 5000) -> LineCrf | None:
    """Learn from the labelled rows where ``fit_on``; None if a class has none."""
    found = feature_rows(training_rows(docs, labels, label_col, fit_on, per_class))
    rows = found.orderBy("further", "draw").limit(chains).select(
        "label", "lines", "features").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["features"])))
    truth = np.array([r["label"] for r in rows])
    if len(set(truth.tolist())) < 2:
        return None
    lines = np.array([r["lines"] for r in rows])
    features = np.frombuffer(b"".join(bytes(r["features"]) for r in rows), np.float32)
    return train(features.reshape(lines.sum(), -1).astype(np.float64), lines, truth)


def score_texts(docs: DataFrame, model: LineCrf | None, text_col: str = "text",
                name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Adds the quality of every text; ``keep`` names the input columns to return."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != name]
    columns = [*kept, text_col] if text_col not in kept else kept
    source, text = docs.select(*columns), columns.index(text_col)
    schema = T.StructType([docs.schema[c] for c in kept]).add(name, T.DoubleType(), False)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, 2 << 20):
                scores = score_bytes(model, texts_of(batch.column(text)))
                out = {c: batch.column(k) for k, c in enumerate(kept)}
                yield pa.RecordBatch.from_pydict(out | {name: pa.array(scores, pa.float64())})

    return source.mapInArrow(score, schema)
