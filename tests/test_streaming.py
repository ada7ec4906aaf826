"""Streams of derived records: restarts, batches done again, joins with static tables."""

import glob

import pytest

from slotweave import Catalog, Mapper, SpecError, parse_specs
from slotweave.streaming import run_stream, stream_results

SPEC = """
class_derivations:
  C:
    populated_from: t
    joins: {u: {join_on: k}}
    slot_derivations: {id: {populated_from: id}, w: {populated_from: u.w}, q: {expr: '100 / {n}'}}
---
class_derivations: {C: {populated_from: t, slot_derivations: {id: {expr: '__import__(1)'}}}}
"""
U = [("a", "A"), ("b", "B"), ("b", "C")]


def add(spark, path, rows):
    spark.createDataFrame(rows, "id string, k string, n string").coalesce(1).write.mode("append").parquet(path)


def mapper_over(spark, path):
    stream = spark.readStream.schema("id string, k string, n string").option("maxFilesPerTrigger", 1).parquet(path)
    return Mapper(Catalog.of(spark, {"t": stream, "u": spark.createDataFrame(U, "k string, w string")}), parse_specs([SPEC]))


def told(spark, root):
    records, errors = stream_results(spark, f"{root}/out", "C")
    return sorted(tuple(r) for r in records.collect()), {(r["table"], r.slot, r.message.split(":")[0]): r.n for r in errors.collect()}


def test_a_later_run_goes_on_after_the_first(spark, tmp_path):
    files = str(tmp_path / "in")
    add(spark, files, [("1", "a", "4"), ("2", "b", "0")])
    run_stream(mapper_over(spark, files), "C", str(tmp_path / "out"), str(tmp_path / "ck"))
    losses = {("u", "k", "rows beyond the first of their join key are left out"): 1, ("t", "", "Import expressions are not supported"): None}
    assert told(spark, tmp_path) == ([("1", "A", 25.0)], {("t", "q", "division by zero"): 1, **losses})
    add(spark, files, [("3", "b", "5"), ("4", None, "x"), ("5", "z", "0")])
    add(spark, files, [("6", "a", "1")])
    queries = run_stream(mapper_over(spark, files), "C", str(tmp_path / "out"), str(tmp_path / "ck"))
    want = [("1", "A", 25.0), ("3", "B", 20.0), ("6", "A", 100.0)]
    errors = {("t", "q", "division by zero"): 2, ("t", "q", "non-numeric value"): 1, **losses}
    assert told(spark, tmp_path) == (want, errors) and not any(q.isActive for q in queries)
    run_stream(mapper_over(spark, files), "C", str(tmp_path / "out"), str(tmp_path / "ck"))  # nothing new
    assert told(spark, tmp_path) == (want, errors)


def test_a_batch_done_again_replaces_its_rows(spark, tmp_path, monkeypatch):
    files = str(tmp_path / "in")
    add(spark, files, [("1", "a", "4")])
    add(spark, files, [("2", "b", "2")])
    kept = DataFrameWriterFailing(monkeypatch, fail_at=1)
    with pytest.raises(Exception, match="lost"):
        run_stream(mapper_over(spark, files), "C", str(tmp_path / "out"), str(tmp_path / "ck"))
    assert len(glob.glob(f"{tmp_path}/out/C/records/source=t/batch=*")) == 2  # the second batch wrote its records, not its errors
    kept.undo()
    run_stream(mapper_over(spark, files), "C", str(tmp_path / "out"), str(tmp_path / "ck"))
    assert told(spark, tmp_path)[0] == [("1", "A", 25.0), ("2", "B", 50.0)]


class DataFrameWriterFailing:
    """Lets the writing of errors fail in one batch, after its records are there."""

    def __init__(self, monkeypatch, fail_at):
        from pyspark.sql.readwriter import DataFrameWriter

        self.monkeypatch, plain = monkeypatch, DataFrameWriter.json

        def json(writer, path, *args, **kwargs):
            if path.endswith(f"batch={fail_at}"):
                raise RuntimeError("lost")
            return plain(writer, path, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, "json", json)

    def undo(self):
        self.monkeypatch.undo()


def test_static_sources_are_refused(spark, tmp_path):
    static = Mapper(Catalog.of(spark, {"t": spark.createDataFrame([("1", "a", "2")], "id string, k string, n string"),
                                       "u": spark.createDataFrame(U, "k string, w string")}), parse_specs([SPEC]))
    with pytest.raises(SpecError, match="not streams"):
        run_stream(static, "C", str(tmp_path / "out"), str(tmp_path / "ck"))
