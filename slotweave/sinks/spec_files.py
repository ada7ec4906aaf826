"""Rendered specs as one text file per cohort, quality and variable.

A file's rows are ordered by phv and text. Their places in it are prefix sums over
range partitions: each partition's bytes are summed, the sums are summed up over the
partitions, and rows are placed within their own partition. So no file is held by one
task or cell; a file beyond PART_BYTES is cut between rows into further files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotweave.errors import SpecError

DEFAULT_LAYOUT = "{cohort}/{quality}/{varname}"
PART_BYTES = 64 << 20


def layout_columns(layout: str) -> list[str]:
    """Columns of a layout pattern; absolute and parent paths are refused."""
    if layout.startswith("/") or re.match(r"^[A-Za-z]+:", layout):
        raise SpecError(f"layout {layout!r} is absolute; it must be relative to the output directory")
    parts = [p for p in re.sub(r"\.ya?ml$", "", layout).split("/") if p]
    if ".." in parts:
        raise SpecError(f"layout {layout!r} leaves the output directory")
    names = [re.fullmatch(r"\{(cohort|quality|varname)\}", p) for p in parts]
    if not names or not all(names):
        raise SpecError(f"layout {layout!r} must be made of {{cohort}}, {{quality}} and {{varname}}")
    return [n[1] for n in names]


def placed_texts(rendered: DataFrame, scratch: str, layout: str = DEFAULT_LAYOUT) -> DataFrame:
    """The distinct texts of every spec file: layout columns, phv, text, how often it stands there, and its first byte.

    ``scratch`` is a new path on a store all executors share, for the ranged rows, which are read twice.
    """
    columns = layout_columns(layout)
    order = [*columns, "phv", "text"]
    spark = rendered.sparkSession
    counted = rendered.select(*order).na.fill("", ["text"]).groupBy(*order).agg(F.count(F.lit(1)).alias("times"))
    size = (F.octet_length("text") * F.col("times")).cast("long")
    ranged = counted.repartitionByRange(*order).select(*order, "times", size.alias("size"), F.spark_partition_id().alias("range"))
    ranged.write.parquet(scratch)
    rows = spark.read.schema(ranged.schema).parquet(scratch)
    # One row per file and range; a file's ranges are as many as it fills.
    sums = rows.groupBy(*columns, "range").agg(F.sum("size").alias("held"))
    before = Window.partitionBy(*columns).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    keys = [F.col(c).alias(f"of_{c}") for c in [*columns, "range"]]
    starts = sums.select(*keys, F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy(*columns, "range").orderBy("phv", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in [*columns, "range"]]
    return placed.join(starts, same).select(*order, "times", (F.col("start") + F.col("inside")).alias("at"))


def write_spec_files(
    rendered: DataFrame, directory: str, layout: str = DEFAULT_LAYOUT, part_bytes: int = PART_BYTES, suffix: str = ".yaml"
) -> None:
    """Rendered specs as ``<layout>.yaml`` files; further parts of a large one are ``<layout>-2.yaml`` and so on.
    Other texts, ordered alike, take another suffix.

    A file is streamed by one task from sorted rows, under another name until it is whole, so a task that
    runs again leaves the same files. A directory that exists is replaced.
    """
    columns = layout_columns(layout)
    bad = [F.col(c).isNull() | F.col(c).isin("", ".", "..") | F.col(c).contains("/") for c in columns]
    unsafe = F.lit(False)
    for b in bad:
        unsafe = unsafe | b
    if rendered.filter(unsafe).limit(1).count():
        raise SpecError("a variable, cohort or quality name would leave its directory")
    fs, root = filesystem(directory)
    if fs.get_file_info(root).type != pyarrow.fs.FileType.NotFound:
        fs.delete_dir(root)
    fs.create_dir(root, recursive=True)
    part = F.floor(F.col("at") / part_bytes).alias("part")
    placed = placed_texts(rendered, f"{directory}/_ranged", layout).select(F.concat_ws("/", *columns).alias("file"), part, "at", "times", "text")
    sent = placed.repartition("file", "part").sortWithinPartitions("file", "part", "at")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(directory)
        attempt = TaskContext.get().taskAttemptId()
        name, out, done = None, None, 0

        def close() -> None:
            out.close()
            final = f"{root}/{name}"
            if fs.get_file_info(final).type != pyarrow.fs.FileType.NotFound:
                fs.delete_file(final)
            fs.move(f"{final}.{attempt}", final)

        for batch in batches:
            for file, part, times, text in zip(*(batch.column(c).to_pylist() for c in ("file", "part", "times", "text"))):
                new = f"{file}{f'-{part + 1}' if part else ''}{suffix}"
                if new != name:
                    if out:
                        close()
                    name = new
                    fs.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}.{attempt}")
                    done += 1
                for _ in range(times):
                    out.write(text.encode())
        if out:
            close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([done], pa.int64())})

    sent.mapInArrow(write, "files long").agg(F.sum("files")).collect()
    fs.delete_dir(f"{root}/_ranged")


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    return pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


def read_spec_files(spark: SparkSession, directory: str) -> list[str]:
    """Texts of the spec files a writer left below a directory (configuration-sized)."""
    files = spark.read.text(directory, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.yaml")
    return [r.value for r in files.selectExpr("_metadata.file_path AS path", "value").orderBy("path").collect()]
