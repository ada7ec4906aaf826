"""Helpers shared by the operators: the shared folder, stored tables, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_ROUNDS = 200
FILTER_BITS = 25


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir), also set for checkpoint().

    Where the setting is absent a folder is made once per session on one machine; on a cluster that is an error.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="slotweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def flagged(df: DataFrame, ids: DataFrame, name: str = "maybe", id_col: str = "id") -> DataFrame:
    """df with a column that is false only where the id is surely not in ids(id); null ids are false.

    The test is a bitmap of hashes of fixed size, FILTER_BITS bits, so it can be broadcast whatever the
    number of ids. It spares a shuffle of wide rows; an exact join of the rows left has to follow.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS))
    found = ids.select(place("id").alias("h"))
    bucket, position = F.bitmap_bucket_number("h"), F.bitmap_bit_position("h")
    maps = found.groupBy(bucket.alias("filter_bucket")).agg(F.bitmap_construct_agg(position).alias("filter_bits"))
    at = F.bitmap_bit_position(place(id_col))
    told = df.join(F.broadcast(stored(maps, "filter")), F.bitmap_bucket_number(place(id_col)) == F.col("filter_bucket"), "left")
    byte = F.conv(F.hex(F.substring("filter_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1
    return told.withColumn(name, F.col(id_col).isNotNull() & F.coalesce(bit, F.lit(False))).drop("filter_bucket", "filter_bits")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links(a, b); component is the least id reachable.

    Labels spread to neighbours and jump along labels, so the rounds grow with the logarithm of a
    chain's length. Every round is stored in the shared folder.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.where("a <> b").distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")), "labels")
    for _ in range(MAX_ROUNDS):
        near = (
            edges.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("jump"))
        moved = stored(
            labels.join(near, "id")
            .join(jump, "component")
            .select("id", "component", F.least("component", "near", "jump").alias("to")),
            "labels",
        )
        labels = moved.select("id", F.col("to").alias("component"))
        if moved.where("to < component").limit(1).count() == 0:
            return labels
    raise RuntimeError(f"no stable components after {MAX_ROUNDS} rounds")
