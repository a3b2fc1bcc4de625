"""Packing along a space-filling curve: like documents share sequences, and nothing is padded.

Every document becomes a vector of hashed token counts, projected at random to ``dims``
coordinates. Each coordinate is spread evenly over a grid by its mean and deviation in the whole
table, and the place of the grid cell on a Hilbert curve is the document's key. Documents are
range-sorted by (key, row number); ranges may divide the copies of one text, so a key that many
rows share is no hot spot. Each range is cut into sequences of ``capacity`` tokens in that order.
What is left at the end of a range is cut into sequences whose lengths are powers of two.

The token ids are written to the shared folder once, before the range sort, so neither its
sampling nor a lost executor encodes a text again.

Defined results: null and empty texts are the end token alone. Rows are packed one by one,
repeated ones and those without an id too; documents of any length are cut where sequences end.
An empty table gives an empty result. Ties go by row number. Other columns are unused.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tillflow.llm.word_bpe import BATCH, load, slices, text_batches
from tillflow.session import scratch_path

BUCKETS = 4096
PIECES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
# Sequences of a range; the number of the range stands above them in a sequence id.
RANGE_BITS = 40


def projection(size: int, dims: int, seed: int = 29) -> np.ndarray:
    """(size, dims): what a token adds to the coordinates, by a signed hash to BUCKETS."""
    rows = np.random.default_rng(seed).normal(size=(BUCKETS, dims))
    mixed = np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sign = np.where(mixed >> np.uint64(40) & np.uint64(1), 1.0, -1.0)
    return (rows[(mixed >> np.uint64(52)).astype(np.int64)] * sign[:, None]).astype(np.float32)


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells of a grid of 2 ** bits in each of the dimensions.

    Skilling's transform (2004) turns coordinates into the curve's index, bit by bit.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            inverted = (x[d] >> level & 1).astype(bool)
            swapped = np.where(inverted, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swapped)
            x[d] ^= swapped if d else 0
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | x[d] >> level & 1
    return key


def token_rows(docs: DataFrame, path: str, end_id: int, dims: int) -> DataFrame:
    """(uid, doc_id, ids, x0, x1, ..): ids in two or four little-endian bytes each."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"),
                       F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = [f"x{d}" for d in range(dims)]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        size = max(len(bpe.tokens), end_id + 1)
        table, width = projection(size, dims), id_width(size)
        table[end_id] = 0
        for batch in text_batches(batches, 2):
            ids, edges = bpe.encode(batch.column(2).to_pylist())
            ids = np.insert(ids, edges[1:], end_id)
            edges = edges + np.arange(len(edges))
            tokens = np.maximum(np.diff(edges) - 1, 1)
            x = [np.add.reduceat(table[:, d][ids], edges[:-1]) / tokens for d in range(dims)]
            raw = ids.astype(width)
            packed = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [
                None, pa.py_buffer((edges * raw.itemsize).astype(np.int64)),
                pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), packed.cast(pa.binary()),
                 *[pa.array(v, pa.float64()) for v in x]], ["uid", "doc_id", "ids", *names])

    return rows.mapInArrow(code, "uid long, doc_id long, ids binary, "
                           + ", ".join(f"{n} double" for n in names))


def id_width(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def with_keys(rows: DataFrame, dims: int, bits: int) -> DataFrame:
    """Adds ``key``. The grid follows the mean and deviation of each coordinate in the table."""
    names = [f"x{d}" for d in range(dims)]
    found = rows.agg(*[f(n) for n in names for f in (F.avg, F.stddev_pop)]).first()
    centre = np.array([v or 0.0 for v in found[::2]])
    spread = np.array([v or 1.0 for v in found[1::2]])

    @F.pandas_udf("long")
    def key(*x: pd.Series) -> pd.Series:
        z = (np.column_stack(x) - centre) / spread
        share = 1 / (1 + np.exp(-np.clip(1.702 * z, -30, 30)))   # about the normal distribution
        cells = np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1)
        return pd.Series(hilbert_key(cells, bits))

    return rows.withColumn("key", key(*names))


class Stretch:
    """Documents or parts of them, one after the other, with their ids."""

    def __init__(self, doc_id: list, start: np.ndarray, whole: np.ndarray, ids: np.ndarray,
                 edges: np.ndarray):
        self.doc_id, self.start, self.whole, self.ids, self.edges = doc_id, start, whole, ids, edges

    def then(self, other: Stretch) -> Stretch:
        return Stretch(self.doc_id + other.doc_id, np.append(self.start, other.start),
                       np.append(self.whole, other.whole), np.append(self.ids, other.ids),
                       np.append(self.edges, self.edges[-1] + other.edges[1:]))

    def cut(self, ends: np.ndarray, first: int) -> list[np.ndarray | list]:
        """PIECES of the sequences that end at ``ends``, numbered from ``first``."""
        begins = np.append(0, ends)[:-1]
        at = np.union1d(self.edges[:-1][self.edges[:-1] < ends[-1]], begins)
        row = np.searchsorted(self.edges, at, side="right") - 1
        sequence = np.searchsorted(begins, at, side="right") - 1
        length = np.diff(np.append(at, ends[-1]))
        raw = memoryview(self.ids[:ends[-1]].astype("<u4")).cast("B")
        crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
        return [[self.doc_id[r] for r in row.tolist()], self.start[row] + at - self.edges[row],
                length, crc, self.whole[row], first + sequence, at - begins[sequence]]

    def after(self, place: int) -> Stretch:
        """What lies behind a place."""
        row = int(np.searchsorted(self.edges, place, side="right")) - 1
        if row >= len(self.doc_id):
            return EMPTY
        start = self.start[row:].copy()
        start[0] += place - self.edges[row]
        edges = self.edges[row:] - place
        edges[0] = 0
        return Stretch(self.doc_id[row:], start, self.whole[row:], self.ids[place:], edges)


EMPTY = Stretch([], np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32),
                np.zeros(1, np.int64))


def powers_of_two(rest: int) -> list[int]:
    """Lengths, each a power of two and the largest first, that add up to ``rest``."""
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack_along_curve(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1,
                     dims: int = 4, bits: int = 8) -> DataFrame:
    """(PIECES) of every document of (doc_id, text)."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "curve-tokens")
    token_rows(docs, path, end_id, dims).write.option("compression", "zstd").parquet(folder)
    rows = with_keys(spark.read.parquet(folder), dims, bits)
    sorted_rows = rows.repartitionByRange("key", "uid").sortWithinPartitions("key", "uid").select(
        "doc_id", "ids")

    def batch_of(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], PIECES)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype(id_width(max(len(load(path).tokens), end_id + 1)))
        number = TaskContext.get().partitionId() << RANGE_BITS
        held = EMPTY
        for batch in itertools.chain.from_iterable(slices(b, 1, BATCH) for b in batches):
            column = batch.column(1).cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[
                column.offset:column.offset + len(column) + 1]
            ids = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(width)
            edges = (offsets - offsets[0]) // width.itemsize
            held = held.then(Stretch(batch.column(0).to_pylist(), np.zeros(len(column), np.int64),
                                     np.diff(edges), ids.astype(np.uint32), edges))
            whole = int(held.edges[-1]) // capacity
            if whole:
                yield batch_of(held.cut(np.arange(1, whole + 1) * capacity, number))
                number += whole
                held = held.after(whole * capacity)
        rest = powers_of_two(int(held.edges[-1]))
        if rest:
            yield batch_of(held.cut(np.cumsum(rest), number))

    return sorted_rows.mapInArrow(pack, ", ".join(f"{c} long" for c in PIECES))
