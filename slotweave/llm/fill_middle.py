"""Fill-in-the-middle by content-defined chunks.

A document is cut into prefix, middle and suffix at two of its n + 1 unit borders, where a
unit is a word with the white space before it (or the white space at the end). Neither n nor
the cuts need the units themselves: the text is cut into chunks where a rolling hash of the
last bytes says so, so equal passages of different documents give equal chunks. Of a chunk
only a boundary summary is needed: its words, and whether it begins or ends inside a word.
Summaries are kept by the chunk's hash and taken only if the kept bytes are the same;
neighbours that share a word count it once. The running counts name the chunk in which a cut
lies, and only this chunk is searched.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
KEEP_PERCENT = 50  # of the documents, by h3, that are transformed
SPM_PERCENT = 80  # of those, by h4, with the suffix before the prefix
MARKS = ("<P>", "<S>", "<M>")

REACH = 16  # bytes the rolling hash sees
CUT_BITS = 9  # one place in 2^9 is a border
LONGEST = 1 << 16  # bytes a chunk has at most
BLOCK = 1 << 20  # bytes hashed at a time
CACHE_BYTES = 32 << 20
WHITE = b" \t\n\x0b\x0c\r"
START = re.compile(rb"[^\x20\x09-\x0D]+")

MULTIPLIER = np.uint32(0x9E3779B1)


# --- chunks ----------------------------------------------------------------


def rolling(raw: np.ndarray) -> np.ndarray:
    """At every byte a polynomial hash of the REACH bytes up to it (fewer at the start), by doubling."""
    h, factor, width = raw.astype(np.uint32) + np.uint32(1), MULTIPLIER, 1
    with np.errstate(over="ignore"):
        while width < REACH:
            h[width:] = h[width:] + h[:-width] * factor if width < len(h) else h[width:]
            factor, width = factor * factor, width * 2
    return h


def borders(raw: bytes) -> list[int]:
    """Ends of the chunks of a text: where the hash of the bytes before has CUT_BITS zeros, and every LONGEST bytes."""
    out, last = [], 0
    for start in range(0, len(raw), BLOCK):
        before = min(start, REACH - 1)
        h = rolling(np.frombuffer(raw[start - before : start + BLOCK], np.uint8))[before:]
        for end in (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + start + 1).tolist():
            while end - last > LONGEST:
                last += LONGEST
                out.append(last)
            last = end
            out.append(end)
    while len(raw) > last:
        last = min(last + LONGEST, len(raw))
        out.append(last)
    return out


@dataclass(frozen=True)
class Summary:
    """Words of a chunk and whether its first and last byte belong to one."""

    words: int
    opens: bool
    closes: bool


def summary(chunk: bytes) -> Summary:
    return Summary(len(chunk.split()), chunk[0] not in WHITE, chunk[-1] not in WHITE)


class Summaries:
    """Boundary summaries by content: found by hash, trusted only if the bytes are equal; the oldest go first."""

    def __init__(self, most: int = CACHE_BYTES) -> None:
        self.most, self.held = most, 0
        self.known: OrderedDict[int, tuple[bytes, Summary]] = OrderedDict()
        self.hits = 0

    def of(self, chunk: bytes) -> Summary:
        key = zlib.crc32(chunk) << 32 | len(chunk)
        entry = self.known.get(key)
        if entry and entry[0] == chunk:
            self.hits += 1
            self.known.move_to_end(key)
            return entry[1]
        told = summary(chunk)
        if entry:
            self.held -= len(entry[0])
        self.known[key] = chunk, told
        self.known.move_to_end(key)
        self.held += len(chunk)
        while self.held > self.most:
            self.held -= len(self.known.popitem(last=False)[1][0])
        return told


class Units:
    """The units of one text, counted by chunk."""

    def __init__(self, raw: bytes, summaries: Summaries) -> None:
        self.raw = raw
        self.ends = borders(raw)
        self.words: list[int] = []  # words that began before the end of each chunk
        total, inside, start = 0, False, 0
        for end in self.ends:
            s = summaries.of(raw[start:end])
            total += s.words - (inside and s.opens)
            inside, start = s.closes, end
            self.words.append(total)
        self.n = total + (bool(raw) and not inside)

    def end_of(self, unit: int) -> int:
        """The byte at which the first `unit` units end."""
        if unit <= 0:
            return 0
        if unit >= self.n:
            return len(self.raw)
        # The unit's word begins in the first chunk whose count reaches it.
        k = int(np.searchsorted(self.words, unit))
        start, before = (self.ends[k - 1], self.words[k - 1]) if k else (0, 0)
        inside = k > 0 and self.raw[start - 1] not in WHITE
        places = START.finditer(self.raw, start, self.ends[k])
        begins = [m.start() for m in places]
        if inside and begins and begins[0] == start:
            begins.pop(0)  # the rest of a word counted before
        found = START.match(self.raw, begins[unit - before - 1])
        return found.end()


# --- documents -------------------------------------------------------------


@dataclass(frozen=True)
class Cut:
    n: int
    form: str
    prefix: str
    middle: str
    suffix: str


def draws(key: str, seed: int = SEED) -> list[int]:
    """Four numbers below 2^32 for a document, the same in every run."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def cut(key: str, text: str | None, summaries: Summaries, keep: int = KEEP_PERCENT, spm: int = SPM_PERCENT, seed: int = SEED) -> Cut:
    """Units, form and parts of a document; a plain one is all prefix."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    units = Units(raw, summaries)
    h1, h2, h3, h4 = draws(key, seed)
    if not raw or h3 % 100 >= keep or any(m in text for m in MARKS):
        return Cut(units.n, "plain", text, "", "")
    a, b = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    i, j = units.end_of(a), units.end_of(b)
    parts = (p.decode("utf-8", "surrogatepass") for p in (raw[:i], raw[i:j], raw[j:]))
    return Cut(units.n, "spm" if h4 % 100 < spm else "psm", *parts)


def assembled(c: Cut) -> str:
    p, s, m = MARKS
    if c.form == "plain":
        return c.prefix
    if c.form == "psm":
        return f"{p}{c.prefix}{s}{c.suffix}{m}{c.middle}"
    return f"{s}{c.suffix}{p}{c.prefix}{m}{c.middle}"


def restored(output: str = "output", form: str = "form") -> Column:
    """The text a transformed document was made from, by its marks alone; no part holds one."""
    out, (p, s, m) = F.col(output), MARKS
    marks = {"psm": (p, s), "spm": (s, p)}
    parts = {}
    for kind, (first, second) in marks.items():
        head, middle = F.substring_index(out, m, 1), F.substring_index(out, m, -1)
        one = F.substring_index(F.substring(head, F.lit(len(first) + 1), F.length(head)), second, 1)
        two = F.substring_index(head, second, -1)
        prefix, suffix = (one, two) if kind == "psm" else (two, one)
        parts[kind] = F.concat(prefix, middle, suffix)
    return F.when(F.col(form) == "psm", parts["psm"]).when(F.col(form) == "spm", parts["spm"]).otherwise(out)


def transformed(docs: DataFrame, keep: int = KEEP_PERCENT, spm: int = SPM_PERCENT, seed: int = SEED) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) per row of docs(id, text, ...).

    n are the text's units, the lengths are code points (null if plain). A null or empty text has no units
    and is plain; a null id draws as an empty one; rows that share an id draw the same numbers, equal rows
    get equal results. Long texts go through in chunks, held whole by their own task only. An empty table
    gives an empty result; other columns are not returned.
    """
    schema = "id long, n long, form string, prefix_chars long, middle_chars long, output string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries = Summaries()
        names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            rows, held = [], 0
            for key, text in zip(batch.column("id"), batch.column("text")):
                key, text = key.as_py(), text.as_py()
                c = cut("" if key is None else str(key), text, summaries, keep, spm, seed)
                lengths = (None, None) if c.form == "plain" else (len(c.prefix), len(c.middle))
                rows.append((key, c.n, c.form, *lengths, assembled(c)))
                held += len(text or "")
                if held > BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

    return docs.select("id", "text").mapInArrow(run, schema)
