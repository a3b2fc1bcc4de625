"""Best-fit packing of token sequences, certified by lower bounds and repacked where they gap.

Documents are cut into pieces of at most ``capacity`` tokens. Full pieces are sequences already.
The others are dealt at random over partitions of bounded size, and each is packed by best-fit
decreasing. Dual feasible functions give a lower bound of each partition's sequences. A partition
that meets its bound is certified: no packing of it is better, and it is settled, all but its
emptiest sequences, so that what is settled has no more than ``capacity / LOOSE`` tokens of room
in a partition. Partitions with a gap exchange all their documents, together with those emptiest
sequences: they are dealt anew and packed by best-fit decreasing again, in partitions of twice the pieces, up to ``2 ** DOUBLINGS`` times those of the
first. That ends when all is settled, when the bound of everything left is met, when
one partition is left, or when an exchange saves less than ``least_saving`` of its sequences. An
exchange that saves none is dropped; while partitions still grow another follows, then the
packing before it stands.

Defined results: null and empty texts are one piece with the end token alone. Rows are packed
one by one, repeated ones and those without an id too. An empty table gives an empty result.
Ties go by row number. Other columns are unused.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillflow.llm.word_bpe import load, text_batches
from tillflow.session import scratch_path

PIECE_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]
PACKED = "bin long, offset long, fill long, loose boolean, bins long, bound long"
LOOSE, DOUBLINGS = 64, 3
# Bits of a sequence id: exchanges, partitions and sequences of a partition.
ROUND_BITS, GROUP_BITS, BIN_BITS = 5, 36, 22


def cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32 of the little-endian ids) of each piece."""
    for piece, start in enumerate(range(0, len(ids), capacity)):
        part = ids[start:start + capacity]
        yield piece, start, len(part), zlib.crc32(part.astype("<u4").tobytes())


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Pieces of every document's ids and ``end_id`` after them."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in text_batches(batches, 1):
            found = []
            texts = batch.column(1).to_pylist()
            for doc_id, ids in zip(batch.column(0).to_pylist(), bpe.encode_batch(texts)):
                found += [(doc_id, *p) for p in cut(np.append(ids, end_id), capacity)]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, PIECE_COLUMNS)

    return rows.mapInArrow(pieces, ", ".join(f"{c} long" for c in PIECE_COLUMNS))


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The largest bound of two families of dual feasible functions.

    The first rounds sizes over capacity - t up to capacity and drops those under t, for every
    t up to half the capacity. The second rounds multiples of capacity / (k + 1).
    """
    return bound_of_counts(np.bincount(sizes, minlength=capacity + 1), capacity)


def bound_of_counts(count: np.ndarray, capacity: int) -> int:
    """The same of how often each size occurs, from 0 to ``capacity``."""
    count = count.astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    up_to_count, up_to_sum = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(0, capacity // 2 + 1)
    big = up_to_count[-1] - up_to_count[capacity - t]
    middle = up_to_sum[capacity - t] - np.where(t > 0, up_to_sum[t - 1], 0)
    best = int((big + -(-middle // capacity)).max())
    for k in range(1, 33):
        # In units of capacity / k, so that all stays whole.
        whole = (k + 1) * size % capacity == 0
        scaled = np.where(whole, k * size, (k + 1) * size // capacity * capacity)
        best = max(best, int(-(-(count * scaled).sum() // (k * capacity))))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size; the fullest bin that still has room is taken."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = n = 0  # rooms: bit r is set if a bin has exactly r tokens of room
    for k in order.tolist():
        size = int(sizes[k])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b, n = capacity, n, n + 1
        bins[k], offsets[k] = b, capacity - room
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets


def sequence_ids(number: int, group: Column, bin_: Column) -> Column:
    """One id for each sequence of each partition of each exchange; none is given twice."""
    if number >= 1 << ROUND_BITS:
        raise ValueError(f"more than {1 << ROUND_BITS} exchanges")
    base = F.lit(number).cast("long") * (1 << GROUP_BITS) + group
    return base * (1 << BIN_BITS) + bin_


def _pack_partitions(pool: DataFrame, groups: int, seed: int, capacity: int) -> DataFrame:
    names = ["uid", *PIECE_COLUMNS, "group"]
    if groups >= 1 << GROUP_BITS:
        raise ValueError(f"more than {1 << GROUP_BITS} partitions")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid", ignore_index=True)
        sizes = rows["length"].to_numpy(np.int64)
        bins, offsets = best_fit_decreasing(sizes, capacity)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        # The emptiest sequences, beyond the room that may stay in a certified partition.
        fullest, loose = np.argsort(-fill, kind="stable"), np.empty(len(fill), bool)
        loose[fullest] = np.cumsum(capacity - fill[fullest]) > capacity // LOOSE
        if len(fill) > 1 << BIN_BITS:
            raise ValueError(f"more than {1 << BIN_BITS} sequences in a partition")
        return rows[names].assign(bin=bins, offset=offsets, fill=fill[bins],
                                  loose=loose[bins], bins=len(fill),
                                  bound=lower_bound(sizes, capacity))

    dealt = pool.select("uid", *PIECE_COLUMNS).withColumn(
        "group", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(groups)))
    schema = ", ".join(f"{c} long" for c in names) + ", " + PACKED
    return dealt.groupBy("group").applyInPandas(pack, schema)


def pack_pieces(pieces: DataFrame, capacity: int, partition_pieces: int = 20_000,
                least_saving: float = 1e-4) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of (PIECE_COLUMNS)."""
    spark = pieces.sparkSession
    folder = scratch_path(spark, "packing")
    pieces.withColumn("uid", F.monotonically_increasing_id()).write.parquet(f"{folder}/pieces")
    pieces = spark.read.parquet(f"{folder}/pieces")
    settled = [pieces.where(F.col("length") == capacity).select(
        *PIECE_COLUMNS, (-F.col("uid") - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))]

    def settle(rows: DataFrame, number: int) -> None:
        settled.append(rows.select(
            *PIECE_COLUMNS, sequence_ids(number, F.col("group"), F.col("bin")).alias(
                "sequence_id"), "offset"))

    pool = pieces.where(F.col("length") < capacity)
    waiting, held = None, 0   # the present packing of the pool, and its sequences
    dealt = number = 0        # the exchange that gave it, and the present one
    while True:
        # At most one row for each length.
        count = np.zeros(capacity + 1, np.int64)
        for row in pool.groupBy("length").count().collect():
            count[row["length"]] = row["count"]
        if not count.sum():
            break
        groups = int(-(-count.sum() // (partition_pieces << min(number, DOUBLINGS))))
        _pack_partitions(pool, groups, number, capacity).write.parquet(f"{folder}/{number}")
        packed = spark.read.parquet(f"{folder}/{number}")
        total = packed.groupBy("group").agg(F.first("bins").alias("bins")).agg(
            F.sum("bins")).first()[0]
        if waiting is not None and total >= held:
            if groups > 1 and number < DOUBLINGS:
                number += 1
                continue
            settle(waiting, dealt)
            break
        slow = waiting is not None and held - total < least_saving * held
        if groups == 1 or slow or total <= bound_of_counts(count, capacity):
            settle(packed, number)
            break
        certified = F.col("bins") == F.col("bound")
        done = certified & ~F.col("loose")
        settle(packed.where(done), number)
        waiting = pool = packed.where(~done)
        held = pool.select("group", "bin").distinct().count()
        dealt, number = number, number + 1
    result = settled[0]
    for part in settled[1:]:
        result = result.unionByName(part)
    return result


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048,
                   partition_pieces: int = 20_000) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    return pack_pieces(token_pieces(docs, path, capacity), capacity, partition_pieces)
