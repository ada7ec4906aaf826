"""MinHash near-duplicates with sequential Bayesian verification.

Documents are sets of word shingles. Texts with the same word sequence are one
node; nodes that share a MinHash band are candidates. A candidate's signatures
are compared batch by batch; after each batch the posterior of its similarity
(uniform prior, a Beta distribution) decides: below the miss probability it is
dropped. Survivors are verified on the full shingle sets.

No bucket is expanded into pairs. Every member is compared with the least and
the greatest id of its bucket; that joins whole families. Buckets whose members
still lie in several components are then compared exhaustively in blocks, inside
tasks that hold two blocks at a time and give a spanning forest of exact links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotweave.llm.common import components, flagged, stored

WORDS = 5
BANDS, ROWS = 24, 5
HASHES = BANDS * ROWS
BATCH = 24
MISS = 1e-7
BLOCK = 512
SLICE = 256
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalising step of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache
def _multipliers() -> np.ndarray:
    return _mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * MULTIPLIER) | np.uint64(1)


def shingles(text: bytes | None) -> tuple[np.ndarray, bytes]:
    """Sorted distinct 64-bit fingerprints of the shingles, and a 128-bit key of the word sequence."""
    words = (text or b"").lower().split()  # of bytes: A-Z only, and white space \x20 \x09-\x0D only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), b""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(WORDS, n)
    s = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        s = s * MULTIPLIER + h[i : n - width + 1 + i]
    return np.unique(_mixed(s)), xxhash.xxh3_128_digest(b" ".join(words))


def signature(s: np.ndarray) -> bytes:
    """The least product with each multiplier, upper 32 bits."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 2048):
        least = np.minimum(least, (_multipliers()[:, None] * s[None, at : at + 2048]).min(axis=1))
    return (least >> np.uint64(32)).astype("<u4").tobytes()


def posterior(agree: int, seen: int, similarity: float) -> float:
    """P(J >= similarity) after `agree` of `seen` hashes agreed, under a uniform prior.

    The tail of Beta(agree + 1, seen - agree + 1) is a binomial sum.
    """
    n = seen + 1
    return sum(math.comb(n, i) * similarity**i * (1 - similarity) ** (n - i) for i in range(agree + 1))


@lru_cache
def bounds(similarity: float, miss: float = MISS) -> tuple[tuple[int, int], ...]:
    """(hashes seen, least agreement that goes on) for every batch."""
    steps = range(BATCH, HASHES + 1, BATCH)
    return tuple((n, next(m for m in range(n + 1) if posterior(m, n, similarity) >= miss)) for n in steps)


def surviving(x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Positions of the signature rows of x and y whose posterior stays above the miss probability."""
    left = np.arange(len(x))
    agree = np.zeros(len(x), np.int32)
    at = 0
    for n, least in bounds(similarity):
        agree[left] += (x[left, at:n] == y[left, at:n]).sum(axis=1, dtype=np.int32)
        left, at = left[agree[left] >= least], n
    return left


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Exact test on two sorted sets: 100 * intersection >= percent * union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    inter = int((both[1:] == both[:-1]).sum())
    return 100 * inter >= percent * (len(x) + len(y) - inter)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, HASHES)


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def signed(docs: DataFrame, keep_set: bool = False) -> DataFrame:
    """(id, n_shingles, seq, sig or shingle set) of docs(id, text bytes); seq and sig are null for an empty set."""
    what = "grams" if keep_set else "sig"

    def run(batches):
        for piece in _pieces(batches):
            n, seq, out = [], [], []
            for text in piece.column("text").to_pylist():
                s, key = shingles(text)
                n.append(len(s))
                seq.append(key or None)
                out.append((s.astype("<u8").tobytes() if keep_set else signature(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(n, pa.int64()), pa.array(seq, pa.binary()), pa.array(out, pa.binary())],
                ["id", "n_shingles", "seq", what],
            )

    source = docs.select("id", F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, f"id long, n_shingles long, seq binary, {what} binary")


def _pruned(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures survive the sequential test."""
    similarity = percent / 100

    def run(batches):
        for piece in _pieces(batches, 4096):
            keep = surviving(_matrix(piece.column("sa")), _matrix(piece.column("sb")), similarity)
            yield piece.select(["a", "b"]).take(pa.array(keep))

    sig = nodes.select("id", "sig")
    return (
        pairs.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a")
        .join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
        .mapInArrow(run, "a long, b long")
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that are links on the full sets."""

    def run(batches):
        for piece in _pieces(batches):
            ga, gb = piece.column("ga").to_pylist(), piece.column("gb").to_pylist()
            keep = [
                i for i, (x, y) in enumerate(zip(ga, gb)) if linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent)
            ]
            yield piece.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
        .mapInArrow(run, "a long, b long")
    )


def _sets(docs: DataFrame, ids: DataFrame, nodes: DataFrame) -> DataFrame:
    """Full shingle sets of the nodes in ids(id)."""
    wanted = nodes.join(ids.distinct(), "id", "left_semi").select("id", "seq")
    wanted = stored(wanted, "wanted")
    texts = flagged(docs, wanted).where("maybe").drop("maybe").join(wanted.select("id").distinct(), "id", "left_semi")
    return stored(signed(texts, keep_set=True).join(wanted, ["id", "seq"], "left_semi").dropDuplicates(["id", "seq"]), "sets")


def _forest(percent: int):
    """Exact links between members of different components in one pair of blocks: a spanning forest."""
    similarity = percent / 100

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_shingles", "ascending"), ("id", "ascending")])
        low, high = key[1].as_py(), key[2].as_py()
        ids, size = table.column("id").to_pylist(), table.column("n_shingles").to_numpy()
        part = table.column("part").to_numpy()
        sig = _matrix(table.column("sig"))
        grams = [np.frombuffer(x, "<u8") for x in table.column("grams").to_pylist()]
        root: dict[int, int] = {}

        def find(x):
            while (up := root.get(x, x)) != x:
                root[x] = x = root.get(up, up)
            return x

        comp = table.column("component").to_pylist()
        a, b = [], []
        for i in range(len(ids)):
            end = int(np.searchsorted(size, size[i] * 100 // percent, side="right"))
            roots = np.array([find(c) for c in comp[i + 1 : end]], np.int64)
            rest = np.flatnonzero(roots != find(comp[i])) + i + 1
            if low != high:
                rest = rest[part[rest] != part[i]]
            if not len(rest):
                continue
            for j in rest[surviving(np.broadcast_to(sig[i], (len(rest), HASHES)), sig[rest], similarity)]:
                x, y = find(comp[i]), find(comp[j])
                if x != y and linked(grams[i], grams[j], percent):
                    root[max(x, y)] = min(x, y)
                    a.append(ids[i])
                    b.append(ids[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row: components under 100 * intersection >= percent * union.

    A document without words has the empty set: it is its own component and is kept. Rows that share an
    id are one node. Rows with a null id are linked with nothing, have a null component and are kept. An
    empty table gives an empty result; other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stored(signed(source), "signatures")
    full = rows.where("id is not null and seq is not null")
    first = stored(full.groupBy("seq").agg(F.min("id").alias("id"), F.max("id").alias("last")), "sequences")
    nodes = full.join(first.select("seq", "id"), ["seq", "id"], "left_semi").dropDuplicates(["seq", "id"])
    nodes = stored(nodes.select("id", "n_shingles", "seq", "sig"), "nodes")

    width = 4 * ROWS
    band = [F.xxhash64(F.substring("sig", 1 + width * k, width), F.lit(k)) for k in range(BANDS)]
    keys = nodes.select("id", F.explode(F.array(*band)).alias("key"))
    buckets = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    members = stored(keys.join(buckets, "key"), "members")
    stars = members.select("id", F.explode(F.array("lo", "hi")).alias("to")).where("id <> to")
    pairs = stars.select(F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b")).distinct()
    alive = stored(_pruned(pairs, nodes, percent), "alive")
    sets = _sets(source, alive.select(F.col("a").alias("id")).union(alive.select("b")), nodes)
    links = stored(_verified(alive, sets, percent), "links")
    # Rows that share an id are one node also where their texts differ: their other texts' first ids join them.
    same = full.join(first.select("seq", F.col("id").alias("b")), "seq").where("id <> b")
    repeated = rows.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    links = links.union(same.join(repeated, "id", "left_semi").select(F.col("id").alias("a"), "b").distinct())
    parts = components(links)

    labelled = members.where("n > 2").join(parts, "id", "left").select("id", "key", "n", F.coalesce("component", "id").alias("component"))
    labelled = stored(labelled, "labelled")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    rest = stored(labelled.join(mixed, "key", "left_semi"), "rest")
    if rest.limit(1).count():
        rest_sets = _sets(source, rest.select("id"), nodes)
        more = _compared(rest, nodes, rest_sets, percent)
        parts = components(links.union(stored(more, "more")))

    named = first.join(parts, "id", "left").select("seq", F.coalesce("component", "id").alias("component_id"))
    named = stored(named, "named")
    slim = rows.select("id", "n_shingles", "seq")
    told = slim.join(named, "seq", "left")
    own = F.when(F.col("seq").isNull(), F.col("id")).otherwise(F.col("component_id"))
    own = F.when(F.col("id").isNotNull(), own)
    return told.select(F.col("id").alias(id_col), "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))
    )


def _compared(rest: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components in buckets that the stars left mixed, by blocks of at most about BLOCK members."""
    parts = F.ceil(F.col("n") / BLOCK)
    dealt = rest.withColumn("parts", parts).withColumn("part", F.expr("pmod(xxhash64(id), parts)"))
    # Of every two blocks one task: a member goes to the tasks (its block, any block), in order.
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    tasks = other.select(
        "id", "key", "component", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    )
    full = tasks.join(nodes.select("id", "n_shingles", "seq", "sig"), "id").join(sets.select("id", "seq", "grams"), ["id", "seq"])
    return full.groupBy("key", "low", "high").applyInArrow(_forest(percent), "a long, b long").distinct()
