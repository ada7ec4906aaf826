"""What the query modules share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from slotweave.plans.derive import Derivation, Mapper
from slotweave.plans.schema import parse_schema
from slotweave.plans.spec import parse_specs
from slotweave.sources.catalog import Catalog

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
PRIMARY_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
}

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Collects queries with their oracle SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.sql[fn.__name__] = sql
            return fn

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; a temporary one where none is set on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = folder or tempfile.mkdtemp(prefix="workload-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog.parquet(spark, sf_dir, TABLES, unique_keys=PRIMARY_KEYS)


def derive(spark: SparkSession, sf_dir: str, entity: str, spec: str, schema: str = "", **extra: DataFrame) -> Derivation:
    """Derive an entity from the given tables (and extra ones made from them)."""
    tables = catalog(spark, sf_dir).extended(extra)
    target = parse_schema(schema) if schema else None
    return Mapper(tables, parse_specs([spec]), target).derive(entity)
