"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Candidates lie in blocks of bounded size, queries in smaller ones; every query block meets
every candidate block. Inside a candidate block each dimension is a list sorted by component.
For a query the lists are read in step, from the end that its sign favours. A candidate's lower
bound takes the least contribution of each list not yet read for it, its upper bound the
contribution the list has come down to; the queries of a block read together. A query's reading
stops when few candidates have an upper bound that reaches the k-th best lower bound: the others
cannot qualify. The scores of those few are
then resolved, and blocks are merged by score, ties to the smaller id.

Defined results: components become floor(scale * x) of x as double, as longs; where sums of
products could pass the range of a long they are added as unbounded integers. A component or a
score among the k best that is no long fails the query: it has no place in the result. Vectors that are null or hold null or non-finite components take no part,
as rows without an id. Equal rows count once; a query never meets candidates of its own id, nor
of another length. Fewer than k candidates give all of them; an empty table gives an empty
result. Other columns are unused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillflow.session import scratch_path

LONG = 1 << 63
# Queries whose floor a task remembers; the floors only save reading.
KNOWN_FLOORS = 100_000
# With so few rows left in a block their scores are resolved and reading stops.
ENOUGH = 64
PACK = "dims int, block long, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, dims, v) with whole components; rows that take no part are left out."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    def long_of(c: Column) -> Column:
        scaled = c.cast("double") * scale
        return F.when(F.abs(scaled) < float(LONG), F.floor(scaled)).otherwise(
            F.raise_error(F.lit("a scaled component passes the range of a long")).cast("long"))

    whole = F.transform(x, long_of)
    return vectors.where(x.isNotNull() & F.col(id_col).isNotNull()).where(finite).select(
        F.col(id_col).cast("long").alias("vec_id"), F.size(x).alias("dims"), whole.alias("v")
    ).dropDuplicates()


def packed_blocks(rows: DataFrame, block: Column) -> DataFrame:
    """One row for each block: its ids and its matrix, sorted by id."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id")
        matrix = np.array(part["v"].tolist(), np.int64).reshape(len(part), -1)
        if not matrix.size or np.array_equal(matrix, matrix.astype(np.int32)):
            matrix = matrix.astype(np.int32)
        return pd.DataFrame({"dims": [part["dims"].iloc[0]], "block": [part["block"].iloc[0]],
                             "ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
                             "vectors": [matrix.tobytes()]})

    return rows.withColumn("block", block).groupBy("dims", "block").applyInPandas(pack, PACK)


class SortedLists:
    """A candidate block: ids, matrix, and for every dimension the rows by rising component.

    ``held`` has the components in that order. ``place`` holds each row's place in each list, so
    that the rows read down to some depth are told by a comparison.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix, self.largest = ids, matrix, _largest(matrix)
        self.rising = np.argsort(matrix.T, axis=1, kind="stable")  # a row for each list
        self.held = np.take_along_axis(matrix.T, self.rising, 1).astype(np.float64)
        self.place = np.empty(matrix.shape, np.int32)
        np.put_along_axis(self.place, self.rising.T,
                          np.arange(len(ids), dtype=np.int32)[:, None], 0)
        # Per list, for what floats lose.
        self.span = np.abs(self.held[:, [0, -1]]).max(axis=1)

    def bounds(self, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (queries, rows) after all lists were read down to ``depth``.

        Lists of positive weights are read from their end, those of negative ones from their
        start. A component that is not yet read gives at least the list's last contribution and
        at most its present one, whatever the weight: so each end has one table of components
        known so far for all queries.
        """
        n = len(self.ids)
        lower = upper = 0.0
        for weights, read, last, present in (
                (np.maximum(queries, 0), self.place >= n - depth, 0, n - depth),
                (np.minimum(queries, 0), self.place < depth, n - 1, depth - 1)):
            weights = weights.astype(np.float64)
            lower = lower + weights @ np.where(read, self.matrix, self.held[:, last]).T
            upper = upper + weights @ np.where(read, self.matrix, self.held[:, present]).T
        return lower, upper

    def tops(self, queries: np.ndarray, own: np.ndarray, k: int, floors: np.ndarray,
             enough: int = ENOUGH) -> list[list[tuple[int, int]]]:
        """For each query the (score, id) of the k best rows, without the query's own id.

        ``floors`` are scores that k rows of other blocks are known to reach. Lists are read for
        the queries for which more than ``enough`` rows can qualify; then those are resolved.
        """
        n, unit = len(self.ids), float(np.finfo(np.float64).eps)
        found: list[list[tuple[int, int]]] = [[] for _ in own]
        open_ones, depth, step = np.arange(len(own)), 0, max(1, n // 4)
        while len(open_ones):
            asked = queries[open_ones]
            others = self.ids != own[open_ones, None]
            if n <= max(k, enough) or depth >= n:
                for q, stays in zip(open_ones, others if not depth else alive):  # noqa: F821
                    found[q] = self._resolved(queries[q], np.flatnonzero(stays), k)
                break
            depth = min(n, depth + step)
            lower, upper = self.bounds(asked, depth)
            lower[~others], upper[~others] = -np.inf, -np.inf
            reach = np.maximum(floors[open_ones], np.partition(lower, n - k, axis=1)[:, n - k])
            # What a bound may be off by: its sums have some dims terms of at most span * |query|.
            slack = 16 * (queries.shape[1] + 2) * unit * (np.abs(asked.astype(np.float64)) @ self.span)
            # A hair below, as the bounds are floats; scores are resolved as whole numbers.
            bound = np.where(reach > -np.inf, reach - slack - 4 * unit * np.abs(reach), -np.inf)
            alive = others & (upper >= bound[:, None])
            few = alive.sum(axis=1) <= max(k, enough)
            for q, stays in zip(open_ones[few], alive[few]):
                found[q] = self._resolved(queries[q], np.flatnonzero(stays), k)
            open_ones, alive = open_ones[~few], alive[~few]
        return found

    def top(self, query: np.ndarray, own: int, k: int, floor: float = -np.inf,
            enough: int = ENOUGH) -> list[tuple[int, int]]:
        """``tops`` of one query."""
        return self.tops(query[None], np.array([own]), k, np.array([floor]), enough)[0]

    def _resolved(self, query: np.ndarray, alive: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best of some rows."""
        rows, ids = self.matrix[alive], self.ids[alive]
        if self.largest * _largest(query) * len(query) < LONG:
            scores = rows @ query
            best = np.lexsort((ids, -scores))[:k]
            return [(int(scores[b]), int(ids[b])) for b in best]
        scores = [sum(a * b for a, b in zip(r, query.tolist())) for r in rows.tolist()]
        best = sorted(range(len(ids)), key=lambda b: (-scores[b], ids[b]))[:k]
        if any(not -LONG <= scores[b] < LONG for b in best):
            raise OverflowError("a score passes the range of a long")
        return [(scores[b], int(ids[b])) for b in best]


def _largest(whole: np.ndarray) -> int:
    """The largest absolute value, as an unbounded integer."""
    return max(int(whole.max()), -int(whole.min())) if whole.size else 0


def _matrix(ids: bytes, vectors: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    kind = np.int64 if len(vectors) > 4 * dims * len(ids) else np.int32
    return ids, np.frombuffer(vectors, kind).reshape(len(ids), -1).astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
          id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 4096,
          query_rows: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows where ``is_query`` (of ``vec_id``)."""
    spark = vectors.sparkSession
    folder = scratch_path(spark, "top-k")
    usable(vectors, id_col, vector_col, scale).withColumn(
        "row", F.monotonically_increasing_id()).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    queries = rows.where(is_query)
    blocks = max(1, -(-rows.count() // block_rows))
    spread = F.pmod(F.xxhash64("row"), F.lit(blocks))
    sets = max(1, -(-queries.count() // query_rows))
    # Written, so that the blocks are not packed again for every pass.
    packed_blocks(rows, spread).write.parquet(f"{folder}/blocks")
    packed_blocks(queries, F.pmod(F.xxhash64("row"), F.lit(sets))).write.parquet(
        f"{folder}/queries")
    # Blocks and queries are rows of one stream, a block before the queries that meet it: joined,
    # each pair would hold a copy of its block, and an Arrow batch thousands of them.
    candidates = spark.read.parquet(f"{folder}/blocks").withColumn("asks", F.lit(False))
    asked = spark.read.parquet(f"{folder}/queries").drop("block").select("*", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.lit(True).alias("asks"))
    order = ["dims", "block", "asks"]
    meeting = candidates.unionByName(asked).repartition("dims", "block").select(
        *order, "ids", "vectors").sortWithinPartitions(*order)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = None  # of the block at hand; a block lies whole in one task
        floors: dict[tuple, float] = {}  # of each query, from the blocks of this task
        for batch in batches:
            for row in range(batch.num_rows):
                dims, block, asks, ids, vecs = (c[row].as_py() for c in batch.columns)
                if not asks:
                    lists = dims, block, SortedLists(*_matrix(ids, vecs, dims))
                    continue
                if lists is None or lists[:2] != (dims, block):
                    continue  # no candidates of that length in this block
                found = []
                owns, asked = _matrix(ids, vecs, dims)
                names = [(int(own), query.tobytes()) for own, query in zip(owns, asked)]
                known = np.array([floors.get(name, -np.inf) for name in names])
                for name, best in zip(names, lists[2].tops(asked, owns, k, known)):
                    found += [(name[0], i, s) for s, i in best]
                    if len(best) == k and len(floors) < KNOWN_FLOORS:
                        floors[name] = max(floors.get(name, -np.inf), best[-1][0])
                columns = list(zip(*found)) or [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return meeting.mapInArrow(search, FOUND).withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", "score")
