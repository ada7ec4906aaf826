"""WARC archives compressed with Zstandard: a writer and a validating reader.

An archive is a skippable frame that holds a compression dictionary, followed by one
frame per record, so any record can be decompressed alone. The reader loads the
dictionary from the leading frame, finds the frames by walking their block headers,
decompresses one frame per record and checks versions, mandatory headers, lengths,
frame checksums and payload digests.

Pages become `response` records. Of pages with the same payload the one with the
largest id is the response; the others become `revisit` records that carry only the
headers and refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotweave.llm.common import new_path, stored

DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 * 1024
DICTIONARY_SAMPLE = 400  # pages
DICTIONARY_PAGE = 32 * 1024  # characters; longer pages are not in the sample
ARCHIVE_BYTES = 16 * 1024 * 1024
LEVEL = 3
DATE = "2025-01-01T00:00:00Z"  # fixed, so that a task that runs again writes the same bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = re.compile(r"<urn:page:(-?\d+|null)>")


class WarcError(ValueError):
    """An archive that is not well formed; the message tells where."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def type(self) -> str:
        return self.headers["warc-type"]


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ---------------------------------------------------------------


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the response's headers, so its full length is known, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else _urn(page_id)[1:-1]
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if revisit:
        headers += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    headers.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n" + block + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def trained_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the samples; empty where they are too few to learn from."""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


class ArchiveWriter:
    """Archives of one task, a new one after ARCHIVE_BYTES; each appears under its name when it is complete."""

    def __init__(self, folder: str, part: int, attempt: int, dictionary: bytes, limit: int = ARCHIVE_BYTES) -> None:
        self.fs, self.folder = pyarrow.fs.FileSystem.from_uri(folder)
        self.part, self.attempt, self.limit = part, attempt, limit
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True, write_content_size=True)
        self.head = dictionary_frame(dictionary) if dictionary else b""
        self.frames: list[bytes] = []
        self.size = self.n = 0

    def add(self, record: bytes) -> Iterator[tuple[str, int, int]]:
        frame = self.compressor.compress(record)
        self.frames.append(frame)
        self.size += len(frame)
        if self.size >= self.limit:
            yield self.close()

    def close(self) -> tuple[str, int, int]:
        name = f"pages-{self.part:06d}-{self.n:05d}.warc.zst"
        unfinished = f"{self.folder}/_{name}.{self.attempt}"
        with self.fs.open_output_stream(unfinished) as out:
            out.write(self.head)
            for frame in self.frames:
                out.write(frame)
        done = f"{self.folder}/{name}"
        if self.fs.get_file_info(done).type != pyarrow.fs.FileType.NotFound:
            self.fs.delete_file(done)  # of an earlier attempt, the same bytes
        self.fs.move(unfinished, done)
        told = (name, len(self.frames), len(self.head) + self.size)
        self.frames, self.size, self.n = [], 0, self.n + 1
        return told


def _uri(folder: str) -> str:
    return folder if re.match(r"\w+:/", folder) else f"file://{folder}"


def write_archives(pages: DataFrame, folder: str, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per page into archives under `folder`; returns (name, records, bytes) per archive.

    A null html is an empty payload. A null id ranks below all others; rows that share the largest id of
    their payload are all responses. A null url gives the record's own name as target. Other columns are
    not read. Names and bytes depend on a task's rows only, so a task that runs again replaces its files.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(page_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload")
    ).withColumn("sha", F.unhex(F.sha1("payload")))
    equal = rows.groupBy("sha").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("sha", "last")
    equal = stored(equal, "payloads")
    rows = rows.join(equal.withColumnRenamed("sha", "same"), F.col("sha") == F.col("same"), "left")
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    rows = rows.withColumn("revisit", revisit).drop("same")

    draw = F.xxhash64(F.col(page_col), F.col(html_col))
    # About twice the sample passes the first test, so the tasks send little to the driver.
    share = F.pmod(draw, F.lit(1 << 30)) < F.lit(float(1 << 30)) * 2 * DICTIONARY_SAMPLE / max(1, pages.count())
    small = pages.where((F.length(html_col) <= DICTIONARY_PAGE) & share).select(F.col(html_col).alias("h"), draw.alias("draw"))
    sample = small.orderBy("draw", "h").limit(DICTIONARY_SAMPLE)
    learned = [record_bytes(0, None, p, payload_digest(p), None, False) for p in (r["h"].encode() for r in sample.collect())]
    dictionary = spark.sparkContext.broadcast(trained_dictionary(learned))
    target = _uri(folder)
    fs, local = pyarrow.fs.FileSystem.from_uri(target)
    fs.create_dir(local, recursive=True)

    def run(batches):
        task = TaskContext.get()
        writer = ArchiveWriter(target, task.partitionId(), task.taskAttemptId(), dictionary.value)
        done = []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    digest = base64.b32encode(r["sha"]).decode()
                    done += writer.add(record_bytes(r["page_id"], r["url"], r["payload"], digest, r["last"], r["revisit"]))
        if writer.frames:
            done.append(writer.close())
        names, records, sizes = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())], ["name", "records", "bytes"]
        )

    rows = rows.sortWithinPartitions("page_id", "sha", "url")
    return stored(rows.mapInArrow(run, "name string, records long, bytes long"), "archives")


# --- reading ---------------------------------------------------------------


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at `at` ends, by its block headers."""
    try:
        n = at + zstandard.frame_header_size(data[at : at + 18])
        checksum = data[at + 4] & 4
        while True:
            header = int.from_bytes(data[n : n + 3], "little")
            if n + 3 > len(data):
                raise WarcError(f"frame at {at} is cut off")
            kind, size = (header >> 1) & 3, header >> 3
            if kind == 3:
                raise WarcError(f"frame at {at} has a block of a reserved type")
            n += 3 + (1 if kind == 1 else size)
            if header & 1:
                break
    except zstandard.ZstdError as e:
        raise WarcError(f"no frame at {at}: {e}") from e
    n += 4 if checksum else 0
    if n > len(data):
        raise WarcError(f"frame at {at} is cut off")
    return n


def leading_dictionary(data: memoryview) -> tuple[bytes, int]:
    """The dictionary in the leading skippable frame (itself compressed or not) and where the records begin."""
    if len(data) < 8:
        return b"", 0
    magic, size = struct.unpack("<II", data[:8])
    if magic != DICTIONARY_MAGIC:
        return b"", 0
    if 8 + size > len(data):
        raise WarcError("the dictionary's frame is cut off")
    content = bytes(data[8 : 8 + size])
    if content[:4] == zstandard.FRAME_HEADER:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return content, 8 + size


def parsed(raw: bytes) -> Record:
    """One record; its header lines, version, mandatory fields and lengths are checked."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise WarcError("no WARC/1.x header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "strict").partition(":")
        if not colon or not re.fullmatch(r"[!-~]+", name):
            raise WarcError(f"bad header line {line[:80]!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"no {name}")
    if not headers["content-length"].isdecimal():
        raise WarcError("content-length is not a number")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"content-length {n}, but {len(rest) - 4} bytes follow")
    return Record(headers, rest[:n])


def records(data: bytes) -> Iterator[Record]:
    """The records of one archive, a frame each. Other skippable frames are passed over."""
    view = memoryview(data)
    dictionary, at = leading_dictionary(view)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    while at < len(view):
        if len(view) - at >= 8 and struct.unpack("<I", view[at : at + 4])[0] & ~15 == 0x184D2A50:
            at += 8 + struct.unpack("<I", view[at + 4 : at + 8])[0]
            if at > len(view):
                raise WarcError("a skippable frame is cut off")
            continue
        end = frame_end(view, at)
        try:
            frame = view[at:end]
            if zstandard.frame_content_size(frame) >= 0:
                raw = decoder.decompress(frame)
            else:
                raw = decoder.decompressobj().decompress(frame)
            yield parsed(raw)
        except (WarcError, zstandard.ZstdError, UnicodeDecodeError) as e:
            raise WarcError(f"record at {at}: {e}") from e
        at = end


def page_of(record: Record) -> tuple[int | None, str, int, str, str, int | None, bytes]:
    """(page_id, url, payload bytes, digest, type, refers_to, payload); lengths and digests of responses are checked."""
    http, mark, payload = record.block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", http)
    digest = record.headers.get("warc-payload-digest", "").removeprefix("sha1:")
    name = ID.fullmatch(record.headers["warc-record-id"])
    if not mark or not http.startswith(b"HTTP/") or not length or not name:
        raise WarcError("no HTTP response of a page")
    if record.headers.get("warc-block-digest", "").removeprefix("sha1:") != payload_digest(record.block):
        raise WarcError("the block does not match its digest")
    refers = None
    if record.type == "revisit":
        to = ID.fullmatch(record.headers.get("warc-refers-to", ""))
        if payload or not to:
            raise WarcError("a revisit with a payload or without a reference")
        refers = None if to[1] == "null" else int(to[1])
    elif record.type != "response":
        raise WarcError(f"unknown record type {record.type}")
    elif len(payload) != int(length[1]) or payload_digest(payload) != digest:
        raise WarcError("the payload does not match its length or digest")
    page_id = None if name[1] == "null" else int(name[1])
    return page_id, record.headers.get("warc-target-uri", ""), int(length[1]), digest, record.type, refers, payload


FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """All records of the archives under `folder`, on any store Spark reads; a malformed archive ends the job.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to and, if asked for, payload.
    """
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payload
    names = [f.split()[0] for f in FIELDS.split(", ")] + ["payload"] * payload

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows = []
                try:
                    for record in records(content.as_buffer()):
                        rows.append(page_of(record)[: len(names)])
                        if len(rows) >= 1000:
                            yield _batch(rows, kinds, names)
                            rows = []
                except WarcError as e:
                    raise WarcError(f"{path.as_py()}: {e}") from e
                if rows:
                    yield _batch(rows, kinds, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("path", "content").mapInArrow(run, FIELDS + ", payload binary" * payload)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages into archives in the shared folder and read them back. No pages, no rows."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    written = write_archives(pages, folder).agg(F.sum("records")).first()[0]
    if not written:
        return spark.createDataFrame([], FIELDS)
    return read_archives(spark, folder, payload=False)
