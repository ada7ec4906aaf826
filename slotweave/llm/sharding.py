"""Sharding over fixed virtual slots.

A record belongs to one of VIRTUAL_SLOTS slots by a hash that never changes. Bytes
are added up per slot, and a map sends slots to shards. The map is a versioned
table: the first version balances bytes; when sizes or the number of shards change,
a new version is written that moves as few slots as the balance asks for.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotweave.functions.local import local_frame
from slotweave.llm.common import new_path, stored

VIRTUAL_SLOTS = 8192
TOLERANCE = 0.01

SlotSizes = dict[int, tuple[int, int]]  # slot -> (bytes, rows)


def virtual_slot(slots: int = VIRTUAL_SLOTS) -> Column:
    """The record's slot. The text's checksum takes part, so rows without an id spread as well."""
    return F.pmod(F.xxhash64(F.lit("slot"), "id", "text_crc32"), F.lit(slots)).cast("int")


def measured(docs: DataFrame, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """docs(id, text) with size (bytes of the text and one more), text_crc32 (0 for null) and virtual_slot."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    sized = docs.withColumn("size", size).withColumn("text_crc32", F.coalesce(F.crc32("text"), F.lit(0)).cast("long"))
    return sized.withColumn("virtual_slot", virtual_slot(slots))


def slot_sizes(rows: DataFrame) -> SlotSizes:
    """Bytes and rows of each slot: as many rows on the driver as there are virtual slots."""
    found = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    return {r["virtual_slot"]: (r["bytes"], r["n"]) for r in found}


def balanced(sizes: SlotSizes, shards: int, slots: int = VIRTUAL_SLOTS) -> dict[int, int]:
    """slot -> shard: the largest slots first, each to the shard with the fewest bytes."""
    heap = [(0, k) for k in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, (0, 0))[0], s)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + sizes.get(slot, (0, 0))[0], shard))
    return out


def rebalanced(old: dict[int, int], sizes: SlotSizes, shards: int, tolerance: float = TOLERANCE) -> dict[int, int]:
    """The map edited for new sizes or shards: slots leave shards above the mean (or gone) until all are within tolerance."""
    out = dict(old)
    size = lambda s: sizes.get(s, (0, 0))[0]
    load = dict.fromkeys(range(shards), 0)
    held: dict[int, list[int]] = {k: [] for k in range(shards)}
    homeless = []
    for slot, shard in sorted(out.items()):
        if shard < shards:
            load[shard] += size(slot)
            held[shard].append(slot)
        else:
            homeless.append(slot)
    goal = sum(map(size, out)) / shards * (1 + tolerance)
    for shard in range(shards):
        for slot in sorted(held[shard], key=lambda s: (-size(s), s)):
            if load[shard] <= goal:
                break
            if 0 < size(slot) and load[shard] - size(slot) >= goal * (1 - 2 * tolerance):
                load[shard] -= size(slot)
                homeless.append(slot)
    heap = [(n, k) for k, n in load.items()]
    heapq.heapify(heap)
    for slot in sorted(homeless, key=lambda s: (-size(s), s)):
        n, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (n + size(slot), shard))
    return out


def write_map(spark: SparkSession, path: str, version: int, shard_of: dict[int, int], sizes: SlotSizes) -> None:
    """Store one version of the map under path/version=N; an existing version is never overwritten."""
    base, seen, rows = {}, {}, []
    for slot, shard in sorted(shard_of.items()):
        n_bytes, n = sizes.get(slot, (0, 0))
        base[slot] = seen.get(shard, 0)
        seen[shard] = base[slot] + n
        rows.append((slot, shard, n_bytes, n, base[slot]))
    frame = local_frame(spark, rows, "map_slot int, shard int, bytes long, n_rows long, first_row long")
    frame.coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    schema = "map_slot int, shard int, bytes long, n_rows long, first_row long"
    return spark.read.schema(schema).parquet(f"{path}/version={version}")


def map_versions(spark: SparkSession, path: str) -> list[int]:
    """All stored versions, by the partition column Spark finds."""
    return sorted(r["version"] for r in spark.read.parquet(path).select("version").distinct().collect())


def newest_version(spark: SparkSession, path: str) -> int:
    """The newest stored version, 0 where there is none."""
    try:
        return max(map_versions(spark, path), default=0)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return 0
        raise


def as_dict(rows: Iterable) -> dict[int, int]:
    return {r["map_slot"]: r["shard"] for r in rows}


def sharded(docs: DataFrame, shards: int = 8, slots: int = VIRTUAL_SLOTS, path: str | None = None) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, virtual_slot, map_version) of every row of docs(id, text).

    `slot` is the row's place in its shard, gapless from 0: the rows of the shard's virtual slots one after
    another, each by id. Null texts count one byte, null ids are placed by their text; rows equal in both
    share a virtual slot and get places of their own. An empty table gives none. The map is stored under
    `path`, or in the shared folder. Where `path` holds a map, its newest version is edited for the rows' sizes
    and the number of shards, and the next version is stored and places the rows; else version 1 is.
    """
    spark = docs.sparkSession
    rows = measured(docs, slots).select("id", "size", "text_crc32", "virtual_slot")
    rows = stored(rows, "sized")
    sizes = slot_sizes(rows)
    path = path or new_path(spark, "slot-map")
    last = newest_version(spark, path)
    old = as_dict(read_map(spark, path, last).collect()) if last else {}
    if last and set(old) != set(range(slots)):
        raise ValueError(f"the map under {path} is not for {slots} virtual slots")
    version = last + 1
    write_map(spark, path, version, rebalanced(old, sizes, shards) if last else balanced(sizes, shards, slots), sizes)
    shard_map = F.broadcast(read_map(spark, path, version))  # one row per virtual slot
    within = Window.partitionBy("virtual_slot").orderBy("id", "text_crc32", "size")
    placed = rows.withColumn("nth", F.row_number().over(within))
    placed = placed.join(shard_map, F.col("virtual_slot") == F.col("map_slot"))
    return placed.select(
        "id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first_row") + F.col("nth") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.lit(version).alias("map_version"),
    )
