"""Exact centroid clustering by Shallot search.

Lloyd's rounds over integer vectors. A vector remembers its nearest and its second-nearest
centroid, an upper bound of its distance to the nearest and a lower bound of that to every
other. Bounds are moved along with the centroids; a vector whose bounds show that nothing
can have changed is not looked at. For the others both remembered centroids are measured
and the scan starts from the closer one: its fellow centroids are tried in order of their
distance to it, as long as they lie within the ball in which a nearest or second-nearest
one can be, and this ball shrinks with every closer one found. Distances are compared as
integers, so ties go to the smaller number exactly; bounds only ever err to the safe side.

A round is one pass over stored rows that carry their bounds, and a grouped sum of the
vectors per centroid; the driver holds the centroids alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotweave.llm.common import stored

DIMS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
ROWS = 8192  # vectors a task searches at a time
SAFE = 1e-12  # relative width kept from every bound for its rounding
STATE = "cluster int, second int, upper double, lower double"


# --- search ----------------------------------------------------------------


def squared(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    d = rows - centroid
    return np.einsum("ij,ij->i", d, d)


@dataclass(frozen=True)
class Centroids:
    """The centroids of a round, with every one's fellows in order of distance."""

    at: np.ndarray  # k x dims, integers
    order: np.ndarray  # per centroid the others, nearest first
    apart: np.ndarray  # their distances to it, never more than true
    moved: np.ndarray  # how far each has come since the round before, never less than true

    @classmethod
    def of(cls, at: np.ndarray, before: np.ndarray | None = None) -> Centroids:
        between = np.stack([squared(at, c) for c in at]) if len(at) else np.zeros((0, 0), np.int64)
        far = between.copy()
        np.fill_diagonal(far, np.iinfo(np.int64).max)
        order = np.argsort(far, axis=1, kind="stable")[:, : max(len(at) - 1, 0)]
        apart = _below(np.take_along_axis(between, order, 1))
        moved = _above(((at - before) ** 2).sum(axis=1)) if before is not None else np.zeros(len(at))
        return cls(at, order, apart, moved)


def _above(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64)) * (1 + SAFE)


def _below(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64)) * (1 - SAFE)


@dataclass
class State:
    """What is known of each vector."""

    cluster: np.ndarray
    second: np.ndarray
    upper: np.ndarray
    lower: np.ndarray


def assigned(rows: np.ndarray, centroids: Centroids, state: State | None = None) -> tuple[State, int]:
    """The nearest centroid of every row, ties to the smaller number, and how many distances that took."""
    n, k = len(rows), len(centroids.at)
    if state is None:
        zero = np.zeros(n, np.int32)
        state = State(zero, np.full(n, min(1, k - 1), np.int32), np.full(n, np.inf), np.zeros(n))
    c, s = state.cluster.astype(np.int64), state.second.astype(np.int64)
    # Every other centroid came nearer by its own way at most: the longest way, or the longest but one for its owner.
    ways = np.argsort(centroids.moved, kind="stable")
    farthest = int(ways[-1])
    rest = centroids.moved[ways[-2]] if k > 1 else 0.0
    upper = (state.upper + centroids.moved[c]) * (1 + SAFE)
    lower = (state.lower - np.where(c == farthest, rest, centroids.moved[farthest])) * (1 - SAFE)
    half = centroids.apart[:, 0] / 2 if k > 1 else np.full(k, np.inf)
    sure = np.maximum(lower, half[c] * (1 - SAFE))
    out = State(state.cluster.copy(), state.second.copy(), upper, lower)
    open_ = np.flatnonzero(~(upper < sure))
    distances = 0
    if len(open_):
        own = squared(rows[open_], centroids.at[c[open_]])
        distances += len(open_)
        out.upper[open_] = _above(own)
        still = ~(out.upper[open_] < sure[open_])
        open_, own = open_[still], own[still]
        distances += _searched(rows, centroids, out, open_, own, c, s)
    return out, distances


def _searched(rows, centroids: Centroids, out: State, open_: np.ndarray, own: np.ndarray, c: np.ndarray, s: np.ndarray) -> int:
    """The scan from the closer of the two remembered centroids, for the rows left open."""
    k, distances = len(centroids.at), 0
    if k == 1 or not len(open_):
        out.upper[open_] = _above(own)
        out.lower[open_] = np.inf
        return 0
    one, two = c[open_], s[open_]
    # A centroid may be remembered twice after the first round only; then its nearest fellow stands in.
    two = np.where(one == two, centroids.order[one, 0], two)
    other = squared(rows[open_], centroids.at[two])
    distances += len(open_)
    swap = (other < own) | ((other == own) & (two < one))
    best, second = np.where(swap, two, one), np.where(swap, one, two)
    d1, d2 = np.where(swap, other, own), np.where(swap, own, other)
    start, reach = best.copy(), _above(d1)  # the ball's centre stays, with the row's distance to it
    for centre in np.unique(start):
        at = np.flatnonzero(start == centre)
        for j, apart in zip(centroids.order[centre], centroids.apart[centre]):
            # A centroid farther from the centre than this is farther from the row than the second nearest.
            at = at[apart <= reach[at] + _above(d2[at])]
            if not len(at):
                break
            todo = at[(one[at] != j) & (two[at] != j)]
            d = squared(rows[open_[todo]], centroids.at[j])
            distances += len(todo)
            first = (d < d1[todo]) | ((d == d1[todo]) & (j < best[todo]))
            next_ = ~first & ((d < d2[todo]) | ((d == d2[todo]) & (j < second[todo])))
            won, placed = todo[first], todo[next_]
            d2[won], second[won] = d1[won], best[won]
            d1[won], best[won] = d[first], j
            d2[placed], second[placed] = d[next_], j
    out.cluster[open_], out.second[open_] = best, second
    out.upper[open_], out.lower[open_] = _above(d1), _below(d2)
    return distances


# --- rounds over DataFrames ------------------------------------------------


def quantised(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(id, q) of vectors(id, vector) with exactly `dims` components, none null or non-finite: q is floor(scale * x)."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ok = vectors.where((F.size("vector") == dims) & ~F.exists("vector", bad))
    q = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return ok.select(F.col("id").cast("long").alias("id"), q.alias("q"))


def starts(rows: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the least hashes of their ids; equal ids go by their components. Fewer, if there are fewer rows."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    least = rows.select(digest.alias("h"), "q").orderBy("h", "q").limit(clusters).collect()
    return np.array([r["q"] for r in least], np.int64)


def _matrix(batch: pa.RecordBatch, column: str = "q") -> np.ndarray:
    q = batch.column(column)
    return q.flatten().to_numpy().reshape(batch.num_rows, -1)


def _stepped(rows: DataFrame, centroids: Centroids, first: bool) -> DataFrame:
    """The rows with their state brought up to the centroids."""
    sent = rows.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "q", "cluster", "second", "upper", "lower"]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                state = None if first else State(*(part.column(n).to_numpy() for n in names[2:]))
                told, _ = assigned(_matrix(part), sent.value, state)
                arrays = [part.column("id"), part.column("q"), pa.array(told.cluster, pa.int32()), pa.array(told.second, pa.int32())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(told.upper), pa.array(told.lower)], names)

    return rows.mapInArrow(run, f"id long, q array<long>, {STATE}")


def _means(rows: DataFrame, at: np.ndarray) -> np.ndarray:
    """Every centroid's vectors' componentwise floor(sum / count); one without vectors stays."""
    dims = at.shape[1]
    sums = [F.sum(F.col("q")[d].cast("decimal(20,0)")).alias(f"s{d}") for d in range(dims)]
    new = at.copy()
    for r in rows.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        new[r["cluster"]] = [int(r[f"s{d}"]) // r["n"] for d in range(dims)]
    return new


def clustered(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per usable row of vectors(id, vector, ...).

    Rows whose vector is null, of another length, or holds a null, NaN or infinite component take no part.
    Rows with a null id are clustered too; they share one start hash. Repeated rows count as often as they
    stand. With fewer rows than clusters each row starts one; an empty table gives an empty result. Other
    columns are not returned. Components must be such that every squared distance fits in a long;
    larger ones raise.
    """
    spark = vectors.sparkSession
    rows = stored(quantised(vectors, dims, scale), "vectors")
    low, high = rows.agg(F.min(F.array_min("q")), F.max(F.array_max("q"))).first()
    if low is None:
        schema = "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], schema)
    if dims * (int(high) - int(low)) ** 2 >= 1 << 63:
        raise ArithmeticError(f"components from {low} to {high}: squared distances do not fit in a long")
    at, before = starts(rows, clusters, seed), None
    for k in range(rounds + 1):
        rows = stored(_stepped(rows, Centroids.of(at, before), k == 0), f"round{k}")
        if k < rounds:
            before, at = at, _means(rows, at)
    return _told(rows, at)


def _told(rows: DataFrame, at: np.ndarray) -> DataFrame:
    """The exact distances and their sums."""
    spark = rows.sparkSession
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at.tolist()]
    fixed = [(k, c, d) for k, (c, d) in enumerate(zip(at.tolist(), digests))]
    centroids = spark.createDataFrame(fixed, "cluster int, centroid array<long>, centroid_sha256 string")
    apart = F.zip_with("q", "centroid", lambda a, b: (a - b) * (a - b))
    distance = F.aggregate(apart, F.lit(0).cast("long"), lambda a, b: a + b)
    told = rows.join(F.broadcast(centroids), "cluster").select("id", "cluster", distance.alias("distance"), "centroid_sha256")
    told = stored(told, "distances")
    sums = {r["cluster"]: int(r["s"]) for r in told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    inertia = [(k, s, sum(sums.values())) for k, s in sums.items()]
    sums_of = spark.createDataFrame(inertia, "cluster int, cluster_inertia long, inertia long")
    columns = ("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return told.join(F.broadcast(sums_of), "cluster").select(*columns)
