"""From documents to shards: language ID, near-duplicates, decontamination, mixing, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.llm import decontaminate, langid, mixing, near_dup, sharding
from slotweave.llm.common import flagged, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a posterior of at least one half; null and letterless texts go."""
    model = langid.train(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    return langid.recognised(docs.select(*COLUMNS), model, least=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8), that with the least id.

    Rows are told apart by a hash of id and text, so different texts that share an id, or have none, are documents of
    their own; of rows equal in id and text one stays.
    """
    keyed = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("row"))
    rows = keyed.select(F.col("row").alias("doc_id"), "text")
    found = near_dup.near_duplicates(rows, percent=NEAR_PERCENT)
    told = stored(found.select(F.col("doc_id").alias("row"), "component_id", "kept"), "kept")
    # Groups of several rows: the ids of their rows say which one stays.
    several = told.where("not kept").select("component_id").distinct()
    members = stored(told.join(several, "component_id", "left_semi").select("row", "component_id").distinct(), "members")
    named = keyed.select("row", "doc_id").join(members, "row")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "row")).alias("first"))
    drop = members.join(first, "component_id").where("row <> first.row").select(F.col("row").alias("id"))
    # Few documents go, so the texts stay where they are: only rows that may have to go are joined.
    drop = stored(drop, "drop")
    repeated = told.groupBy("row").count().where("count > 1").select("row")
    repeated = stored(repeated, "repeated")
    tested = flagged(keyed, drop.union(repeated), id_col="row")
    maybe = tested.where("maybe").drop("maybe").join(drop.withColumnRenamed("id", "row").distinct(), "row", "left_anti")
    once = maybe.join(repeated, "row", "left_anti")
    again = maybe.join(repeated, "row", "left_semi").dropDuplicates(["doc_id", "text"])
    return tested.where("not maybe").select(*COLUMNS).union(once.select(*COLUMNS)).union(again.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(F.col("item_id").alias("id"), "text")
    return decontaminate.clean(docs.select(*COLUMNS), items)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    mix = mixing.mixed(docs.select(*COLUMNS).withColumnRenamed("doc_id", "id"))
    times = mix.where("copies > 0").withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return times.withColumnRenamed("id", "doc_id").select(*COLUMNS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and place, with the text it holds there by its checksum."""
    return sharding.sharded(docs.select(F.col("doc_id").alias("id"), "text")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", source_mixing),
    ("sharding", shards),
]
#: The stages learn, hash and align: SQL can't express them; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
