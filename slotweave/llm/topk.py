"""Exact top-k inner products over a bit-sliced index.

Vectors are quantised to integers, floor(1024 x). Rows are dealt into blocks; in a
block every dimension is offset to start at 0 and its upper KEPT_BITS bits are stored
as slices: bitmaps with one bit per row. For a query the slices are added, each at its
weight, by carry-save adders over the bitmaps; the result is again a list of slices, a
lower bound of each row's score. The k best rows are selected from the most significant
slice downward. What the dropped bits could add is bounded, so all rows within that
bound of the k-th are scored exactly and ranked.

The queries are a stated set: every block of rows meets every block of queries.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotweave.llm.common import stored

SCALE = 1024
KEPT_BITS = 8
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 16_384
LONG = 1 << 63
SMALL = 1 << 24  # of a quantised component: scores of up to 2^13 dimensions fit in a long


# --- bit slices ------------------------------------------------------------


def packed(bits: np.ndarray) -> np.ndarray:
    """Booleans as 64-bit words, the rest of the last word zero."""
    out = np.zeros(-(-len(bits) // 64) * 8, np.uint8)
    raw = np.packbits(bits, bitorder="little")
    out[: len(raw)] = raw
    return out.view(np.uint64)


def unpacked(words: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(words.view(np.uint8), count=n, bitorder="little").astype(np.bool_)


def count(words: np.ndarray) -> int:
    return int(np.bitwise_count(words).sum())


class SlicedBlock:
    """Rows of quantised vectors as bit slices per dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, kept_bits: int = KEPT_BITS) -> None:
        self.ids, self.rows = ids, rows
        self.low = rows.min(axis=0)
        spread = int((rows.max(axis=0) - self.low).max(initial=0))
        self.shift = max(0, spread.bit_length() - kept_bits)
        self.width = max(1, spread.bit_length() - self.shift)
        coarse = (rows - self.low) >> self.shift
        self.slices = [[packed((coarse[:, d] >> b) & 1 == 1) for b in range(self.width)] for d in range(rows.shape[1])]
        self.all = packed(np.ones(len(ids), np.bool_))

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of a lower bound of (score - constant) >> shift for each row, and the most the bound can be short.

        A negative weight takes the complement of the coarse value, so all weights are positive.
        """
        columns: dict[int, list[np.ndarray]] = {}
        for d, q in enumerate(query.tolist()):
            weight, bits = abs(q), self.slices[d]
            bits = [s ^ self.all for s in bits] if q < 0 else bits
            at = 0
            while weight >> at:
                if weight >> at & 1:
                    for b, s in enumerate(bits):
                        columns.setdefault(at + b, []).append(s)
                at += 1
        out, k = [], 0
        while k <= max(columns, default=-1):
            column = columns.get(k, [])
            while len(column) > 2:  # full adders: three slices become a sum and a carry
                a, b, c = column.pop(), column.pop(), column.pop()
                x = a ^ b
                column.append(x ^ c)
                columns.setdefault(k + 1, []).append((a & b) | (x & c))
            if len(column) == 2:
                a, b = column
                columns.setdefault(k + 1, []).append(a & b)
                column = [a ^ b]
            out.append(column[0] if column else np.zeros_like(self.all))
            k += 1
        return out, int(np.abs(query).sum()) if self.shift else 0

    def candidates(self, query: np.ndarray, k: int, allowed: np.ndarray) -> np.ndarray:
        """Row numbers that hold the k best allowed rows, ties included."""
        slices, slack = self.scores(query)
        sure, open_ = np.zeros_like(self.all), allowed
        if count(allowed) <= k:
            return np.flatnonzero(unpacked(allowed, len(self.ids)))
        threshold = 0
        for b in range(len(slices) - 1, -1, -1):
            both = open_ & slices[b]
            n = count(sure | both)
            if n >= k:
                open_ = both
                threshold |= 1 << b
            else:
                sure |= both
                open_ = open_ & ~slices[b]
        # The k-th best bound is the threshold; true values exceed a bound by less than the slack.
        return np.flatnonzero(unpacked(self._at_least(slices, threshold - slack) & allowed, len(self.ids)))

    def _at_least(self, slices: list[np.ndarray], value: int) -> np.ndarray:
        """Rows whose sliced number is at least the value."""
        if value <= 0:
            return self.all
        if value >> len(slices):
            return np.zeros_like(self.all)
        more, same = np.zeros_like(self.all), self.all
        for b in range(len(slices) - 1, -1, -1):
            if value >> b & 1:
                same = same & slices[b]
            else:
                more = more | (same & slices[b])
                same = same & ~slices[b]
        return more | same

    def best(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(id, score) of the k best rows but the query's own, ties to the smaller id."""
        allowed = self.all
        own = self.ids == query_id
        if own.any():
            allowed = allowed & ~packed(own)
        rows = self.candidates(query, k, allowed)
        score = self.rows[rows] @ query
        order = np.lexsort((self.ids[rows], -score))[:k]
        return list(zip(self.ids[rows][order].tolist(), score[order].tolist()))


# --- blocks of rows and queries ---------------------------------------------


def quantised(vectors: DataFrame) -> DataFrame:
    """(id, dims, q) of vectors(id, vector): q holds floor(1024 x) per component.

    Rows with a null id, a null or empty vector, or a null, NaN or infinite component take no part.
    A component whose 1024-fold does not fit in a long ends the job.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ok = vectors.where(F.col("id").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", bad))
    x = F.transform(F.col("vector"), lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    return ok.select(F.col("id").cast("long").alias("id"), F.size("vector").alias("dims"), x.alias("q"))


def top_k(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each row of vectors(id, vector) with is_query true.

    Only vectors of the query's length compete; the query's own id does not. A query with fewer
    candidates gets them all. Rows that share an id are each a candidate; equal ids with equal scores
    rank in any order. An empty table, or one without queries, gives an empty result; other columns are
    read by `is_query` alone.
    """
    every = stored(quantised(vectors), "quantised")
    row_blocks, query_blocks = F.lit(1), F.lit(1)
    for r in every.groupBy("dims").agg(F.count("*").alias("n"), F.count_if(is_query).alias("m")).collect():
        row_blocks = F.when(F.col("dims") == r["dims"], -(-r["n"] // BLOCK_ROWS)).otherwise(row_blocks)
        query_blocks = F.when(F.col("dims") == r["dims"], max(1, -(-r["m"] // BLOCK_QUERIES))).otherwise(query_blocks)
    # A tile is a block of rows and a block of queries: both sides are sent once for every block of the other.
    dealt = F.xxhash64("id", "q")
    to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), (n - 1).cast("long")))
    rows = every.withColumn("block", F.pmod(dealt, row_blocks)).withColumn("qblock", to(query_blocks))
    queries = every.where(is_query).withColumn("qblock", F.pmod(dealt, query_blocks)).withColumn("block", to(row_blocks))

    def tile(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if mine.num_rows and theirs.num_rows:
            rows, queries = _matrix(mine), _matrix(theirs)
            ids, query_ids = mine.column("id").to_numpy(), theirs.column("id").to_numpy()
            # Vectors whose scores might not fit in a long are scored by Python's integers.
            most = lambda m: max(int(m.max(initial=0)), -int(m.min(initial=0)))
            if rows.shape[1] * most(rows) * most(queries) < LONG >> 2:
                out = _best(ids, rows, query_ids, queries, k)
            else:
                small = lambda m: np.abs(m).max(axis=1) < SMALL
                out = _best(ids[small(rows)], rows[small(rows)], query_ids[small(queries)], queries[small(queries)], k)
                for i, q in zip(query_ids.tolist(), queries.tolist()):
                    wide = ~small(rows) if max(map(abs, q)) < SMALL else np.ones(len(rows), bool)
                    out += _best_exactly(ids[wide].tolist(), rows[wide].tolist(), i, q, k)
        columns = zip(*out) if out else ((), (), ())
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    keys = ("dims", "block", "qblock")
    tiles = rows.groupBy(*keys).cogroup(queries.groupBy(*keys))
    found = tiles.applyInArrow(tile, "query_id long, vec_id long, score long")
    ranks = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _best(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    if not len(ids) or not len(query_ids):
        return []
    block = SlicedBlock(ids, rows)
    return [(i, vec, score) for i, q in zip(query_ids.tolist(), queries) for vec, score in block.best(i, q, k)]


def _best_exactly(ids: list[int], rows: list[list[int]], query_id: int, query: list[int], k: int) -> list[tuple[int, int, int]]:
    scored = ((sum(a * b for a, b in zip(r, query)), i) for i, r in zip(ids, rows) if i != query_id)
    best = heapq.nsmallest(k, ((-s, i) for s, i in scored))
    if any(not -LONG <= -s < LONG for s, _ in best):
        raise ArithmeticError(f"a score of vector {query_id} does not fit in a long")
    return [(query_id, i, -s) for s, i in best]


def _matrix(table: pa.Table) -> np.ndarray:
    values = table.column("q").combine_chunks()
    values = pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy().astype(np.int64).reshape(table.num_rows, -1)
