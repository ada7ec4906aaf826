"""Line deduplication against levelled sorted runs of line hashes.

A run is a table of 128-bit line hashes, bucketed and sorted by hash. Documents come
in batches of ascending ids. Each batch's distinct lines are merge-joined with the
runs: a line that a run has was seen in an earlier document; the others become a new
run of level 0. When a level holds FANOUT runs they are merged into one of the next
level. Buckets line up with the join, so the runs are never shuffled or sorted again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.llm.common import stored

LEAST = 10  # code points of a line's key
FANOUT = 2
BATCHES = 4
SLICE = 512
HOT = 10_000  # a line is hot if it has over 1 / HOT of all (document, line) pairs, so fewer than HOT lines are
LAST_ID = (1 << 63) - 1  # stands for a null id: one document after all others
SPACE = b" \t\n\x0b\x0c\r"


def line_hash(line: bytes) -> bytes | None:
    """The hash of the line's key: stripped, A-Z lower-cased; None for a key of fewer than LEAST code points."""
    key = line.strip(SPACE).lower()  # of bytes: A-Z only
    if len(key) < LEAST or (len(key) < 4 * LEAST and len(key.decode()) < LEAST):
        return None
    return xxhash.xxh3_128_digest(key)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def row_key() -> Column:
    return F.xxhash64(F.col("text").cast("binary")).alias("row")


def line_hashes(docs: DataFrame) -> DataFrame:
    """(id, row, h): the distinct hashes of every row of docs(id, text); `row` is a hash of the text, so rows of one id part."""

    def run(batches):
        for piece in _slices(batches):
            ids, rows, out = [], [], []
            for i, row, text in zip(*(piece.column(c).to_pylist() for c in ("id", "row", "text"))):
                found = {h for line in (text or b"").split(b"\n") if (h := line_hash(line))}
                ids += [i] * len(found)
                rows += [row] * len(found)
                out += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(out, pa.binary())], ["id", "row", "h"])

    return docs.select("id", row_key(), F.col("text").cast("binary").alias("text")).mapInArrow(run, "id long, row long, h binary")


class LineRuns:
    """The runs of one collection. Use as a context manager or call drop() when no further batch comes."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.made = 0

    def __enter__(self) -> LineRuns:
        return self

    def __exit__(self, *_) -> None:
        self.drop()

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(t) for level in self.levels for t in level]

    def _write(self, hashes: DataFrame) -> str:
        name = f"{self.name}_{self.made}"
        self.made += 1
        dealt = hashes.repartition(self.buckets, "h")
        dealt.write.bucketBy(self.buckets, "h").sortBy("h").format("parquet").saveAsTable(name)
        return name

    def add(self, hashes: DataFrame) -> None:
        """A new run of hashes that no run has; full levels are merged upwards."""
        fresh, level = self._write(hashes), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(fresh)
            if len(self.levels[level]) < self.fanout:
                return
            merged = reduce(DataFrame.union, [self.spark.table(t) for t in self.levels[level]])
            fresh = self._write(merged)
            for t in self.levels[level]:
                self.spark.sql(f"DROP TABLE {t}")
            self.levels[level] = []
            level += 1

    def seen(self, lines: DataFrame) -> DataFrame:
        """lines(h, ...) with `known`: whether any run has the hash. One merge join per run, none of them shuffled."""
        known, lines = F.lit(False), lines.repartition(self.buckets, "h")
        for k, run in enumerate(self.tables()):
            mark = f"in_{k}"
            lines = lines.join(run.select(F.col("h").alias(f"h_{k}"), F.lit(True).alias(mark)), F.col("h") == F.col(f"h_{k}"), "left")
            known = known | F.coalesce(mark, F.lit(False))
        return lines.select("h", "first", "last", "n", known.alias("known"))

    def batch(self, docs: DataFrame) -> DataFrame:
        """(id, row, h) of the lines that the batch docs(id, text) has to drop; its new lines join the runs.

        A line is dropped if a run knows it, or in the batch's documents after the first that holds it.
        A hot line's documents are dealt into as many parts as its share asks for, so that no part holds
        more than about 1 / HOT of all pairs; the numbers of parts, fewer than HOT rows, are broadcast.
        """
        lines = line_hashes(docs)
        spans = lines.groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
        spans = stored(self.seen(spans), "lines")
        self.add(spans.where("not known").select("h"))
        shared = stored(spans.where("known or first < last").select("h", "first", "known", "n"), "shared")
        pairs = spans.agg(F.sum("n")).first()[0] or 0
        parts = F.ceil(F.col("n") * HOT / max(pairs, 1))
        hot = shared.where(F.col("n") * HOT > pairs).select("h", parts.alias("parts"))
        dealt = lines.join(F.broadcast(hot), "h", "left").withColumn("part", F.pmod(F.xxhash64("id", "row"), F.coalesce("parts", F.lit(1))))
        ours = shared.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(parts, F.lit(1)) - 1)))
        return stored(dealt.join(ours, ["h", "part"]).where("known or id > first").select("id", "row", "h"), "dropped")

    def drop(self) -> None:
        for level in self.levels:
            for t in level:
                self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        self.levels = []


def without_repeated_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """docs(id, text) as (id, n_lines, n_dropped, text): every repeated line stays in its smallest document only.

    Lines with keys under LEAST code points always stay. A null or empty text is one empty line. Rows that
    share an id are one document; a null id counts as one document after all others. An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col("id").cast("long"), F.lit(LAST_ID)).alias("id"), "text")
    shares = [k / batches for k in range(1, batches)]
    cuts = source.agg(F.percentile_approx("id", shares, 1000).alias("at")).first()["at"] or []
    edges = [None, *sorted(set(cuts)), None]
    dropped = []
    with LineRuns(spark) as runs:
        for low, high in zip(edges, edges[1:]):
            part = source
            part = part if low is None else part.where(F.col("id") > low)
            part = part if high is None else part.where(F.col("id") <= high)
            dropped.append(runs.batch(part))
    gone = reduce(DataFrame.union, dropped).groupBy("id", "row").agg(F.collect_set("h").alias("gone"))

    def run(parts):
        for piece in _slices(parts):
            n, lost, kept = [], [], []
            for text, gone in zip(piece.column("text").to_pylist(), piece.column("gone").to_pylist()):
                lines = (text or b"").split(b"\n")
                drop = set(gone or ())
                stay = [line for line in lines if not drop or line_hash(line) not in drop]
                n.append(len(lines))
                lost.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            arrays = [piece.column("id"), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_lines", "n_dropped", "kept"])

    told = source.select("id", row_key(), F.col("text").cast("binary").alias("text")).join(gone, ["id", "row"], "left")
    out = told.mapInArrow(run, "id long, n_lines long, n_dropped long, kept binary")
    own = F.when(F.col("id") != LAST_ID, F.col("id"))
    return out.select(own.alias("id"), "n_lines", "n_dropped", F.col("kept").cast("string").alias("text"))
