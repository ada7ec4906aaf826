"""Derivations over streaming tables.

A derivation is a stateless projection with joins to static tables, so a
catalogue may hold a streaming DataFrame; the records are then a stream.

``run_stream`` writes an entity from its streams: each micro-batch derives its rows once and
leaves records and errors under its own number, so a batch that is done again after a failure
replaces what it left before.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slotweave.errors import SpecError
from slotweave.plans.derive import ERROR_SUMMARY, Mapper

BATCH = "batch"


def stream_records(mapper: Mapper, entity: str) -> DataFrame:
    """The records of an entity as a stream; each of its source tables must be one."""
    _require_streams(mapper, entity)
    return mapper.derive(entity).records


def _require_streams(mapper: Mapper, entity: str) -> list[str]:
    tables = sorted({b.populated_from for b in mapper.specs.blocks(entity)})
    static = [t for t in tables if not mapper.catalog[t].isStreaming]
    if static:
        raise SpecError(f"{entity!r} reads tables that are not streams: {static}")
    return tables


def run_stream(mapper: Mapper, entity: str, directory: str, checkpoint: str, **trigger) -> list[StreamingQuery]:
    """Derive every new row of the entity's streams into ``directory``; returns the queries, one per table.

    Without a ``trigger`` (see ``DataStreamWriter.trigger``) all rows that are there are read and the
    queries have ended on return; a later call with the same checkpoint goes on after them. A row that
    fails goes to the counted errors; refused blocks and join losses are told with the first batch.
    """
    queries = []
    for table in _require_streams(mapper, entity):
        stream = mapper.catalog[table].writeStream.foreachBatch(_batch_writer(mapper, entity, table, directory))
        stream = stream.option("checkpointLocation", f"{checkpoint}/{entity}/{table}").queryName(f"{entity}/{table}")
        queries.append(stream.trigger(**(trigger or {"availableNow": True})).start())
    if not trigger:
        for q in queries:
            q.awaitTermination()
    return queries


def _batch_writer(mapper: Mapper, entity: str, table: str, directory: str):
    def write(batch: DataFrame, number: int) -> None:
        # The other tables give their column types only: of the derivation this table's part is run.
        derivation = mapper.over(mapper.catalog.extended({table: batch})).derive(entity)
        first = number == 0
        part = replace(
            derivation,
            staged={table: derivation.staged[table]} if table in derivation.staged else {},
            kinds={t: k for t, k in derivation.kinds.items() if t == table},
            refused=[r for r in derivation.refused if r[1] == table] if first else [],
            dropped=derivation.dropped if first else [],
        )
        records, errors = part.observed()
        place = f"source={table}/{BATCH}={number}"
        records.records.write.mode("overwrite").parquet(f"{directory}/{entity}/records/{place}")
        errors().write.mode("overwrite").json(f"{directory}/{entity}/errors/{place}")

    return write


def stream_results(spark: SparkSession, directory: str, entity: str) -> tuple[DataFrame, DataFrame]:
    """(records, errors) that all batches have left; the errors are summed up."""
    records = spark.read.parquet(f"{directory}/{entity}/records").drop("source", BATCH)
    found = spark.read.schema(ERROR_SUMMARY).json(f"{directory}/{entity}/errors")
    errors = found.groupBy("entity", "table", "slot", "message").agg(F.sum("n").alias("n"))
    return records, errors
