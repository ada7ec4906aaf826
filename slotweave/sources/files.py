"""Headers of any number of text files in one job, and rows of files whose header must be found first.

A Python data source with one partition a file. Its task walks the lines until it has the
header; asked for headers it stops there, so a compressed file is not read further than its
comment block. Files are opened through pyarrow's file systems (local paths, HDFS with
libhdfs, S3, GCS), also compressed ones. A second source gives the columns of any number of
tables from their headers or Parquet footers, some files a task.
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from slotweave.functions.text import class_name_of_file

SOURCE = "headed_text"
LAYOUTS = ("markers", "blank", "first")
LINES_AT_ONCE = 8192
COLUMNS_SOURCE = "table_columns"
FILES_A_TASK = 64
#: Fixed value: the key column that heads every archive.
SUBJECT = "dbGaP_Subject_ID"


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


def lines_of(path: str) -> Iterator[str]:
    """The lines of a text file, without their ends; a known compression is undone."""
    fs, local = opened(path)
    with fs.open_input_stream(local, compression="detect") as raw:
        for line in io.TextIOWrapper(io.BufferedReader(raw, 1 << 20), encoding="utf-8", errors="replace"):
            yield line.rstrip("\n")


def headed(lines: Iterator[str], layout: str) -> tuple[str | None, Iterator[str]]:
    """The header line of a file and the lines after it; None and no lines where there is no header.

    markers: the first line that begins with ``##``; blank: the line after the first blank one, and a
    names line right after it is dropped; first: the first line.
    """
    if layout == "markers":
        header = next((x for x in lines if x.startswith("##")), None)
    else:
        if layout == "blank":
            next((x for x in lines if x == ""), None)
        header = next(lines, None)
    if layout == "blank" and header is not None:
        after = next(lines, None)
        if after is not None and not after.startswith(SUBJECT):
            lines = chain([after], lines)
    return header, lines


class File(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)


class HeadedTextReader(DataSourceReader):
    def __init__(self, paths: list[str], layout: str, rows: bool) -> None:
        self.paths, self.layout, self.rows = paths, layout, rows

    def partitions(self) -> list[InputPartition]:
        return [File(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path = partition.value
        header, lines = headed(lines_of(path), self.layout)
        if not self.rows:
            yield self._batch(path, [header])
            return
        while some := list(islice(lines, LINES_AT_ONCE)):
            yield self._batch(path, some)

    @staticmethod
    def _batch(path: str, lines: list[str | None]) -> pa.RecordBatch:
        arrays = [pa.array([path] * len(lines), pa.string()), pa.array(lines, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["path", "line"])


class HeadedText(DataSource):
    """(path, line): the header of every file, null where it has none, or with ``rows`` the lines after it."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "path string, line string"

    def reader(self, schema) -> DataSourceReader:
        layout = self.options.get("layout", "markers")
        if layout not in LAYOUTS:
            raise ValueError(f"layout {layout!r} is none of {LAYOUTS}")
        return HeadedTextReader(json.loads(self.options["paths"]), layout, self.options.get("rows", "false") == "true")


def headed_text(spark: SparkSession, paths: list[str], layout: str, rows: bool = False) -> DataFrame:
    """(path, line): headers of the files in one job, or their rows; a task per file."""
    spark.dataSource.register(HeadedText)
    read = spark.read.format(SOURCE).option("paths", json.dumps(list(paths))).option("layout", layout)
    return read.option("rows", str(rows).lower()).load()


def file_headers(spark: SparkSession, paths: list[str], layout: str) -> dict[str, str]:
    """The header line of every file that has one, from one job."""
    if not paths:
        return {}
    return {r["path"]: r["line"] for r in headed_text(spark, paths, layout).collect() if r["line"] is not None}


def separator_of(header: str) -> str:
    """Tab or comma, whichever a header line holds more often in its first 1024 characters; tab on a tie."""
    header = header[:1024]
    return "\t" if header.count("\t") >= max(header.count(","), 1) else ","


def part_of(path: str) -> str:
    """The path itself, or of a folder that Spark wrote its first part file."""
    fs, local = opened(path)
    if fs.get_file_info(local).type != pyarrow.fs.FileType.Directory:
        return path
    inside = fs.get_file_info(pyarrow.fs.FileSelector(local, recursive=True))
    names = [f.path[len(local.rstrip("/")) + 1 :] for f in inside if f.is_file]
    parts = sorted(n for n in names if not any(x.startswith(("_", ".")) for x in n.split("/")))
    if not parts:
        raise FileNotFoundError(f"{path} holds no part file")
    return f"{path.rstrip('/')}/{parts[0]}"


def columns_of(path: str) -> list[str]:
    """The column names of a table, as its Parquet footer or the header line of its delimited file has them."""
    part = part_of(path)
    if part.endswith(".parquet"):
        fs, local = opened(part)
        return pyarrow.parquet.read_schema(local, filesystem=fs).names
    header = next(lines_of(part), "").removeprefix("\ufeff")
    return next(csv.reader([header], delimiter=separator_of(header)), [])


class Files(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        super().__init__(paths)


class TableColumnsReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [Files(self.paths[i : i + FILES_A_TASK]) for i in range(0, max(1, len(self.paths)), FILES_A_TASK)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for path in partition.value:
            table = class_name_of_file(path)
            for i, column in enumerate(columns_of(path), 1):
                yield path, table, i, column


class TableColumns(DataSource):
    """(path, table, position, column) of every column of the files; tables are named after their files."""

    @classmethod
    def name(cls) -> str:
        return COLUMNS_SOURCE

    def schema(self) -> str:
        return "path string, `table` string, position int, `column` string"

    def reader(self, schema) -> DataSourceReader:
        return TableColumnsReader(json.loads(self.options["paths"]))


def table_columns(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The columns of any number of delimited and Parquet tables from one job that reads headers and footers only."""
    spark.dataSource.register(TableColumns)
    return spark.read.format(COLUMNS_SOURCE).option("paths", json.dumps(list(paths))).load()
