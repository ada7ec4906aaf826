"""Benchmark decontamination by the q-gram lemma.

An item of m characters that lies in a text with at most k edits shares at least
m + 1 - q * (k + 1) of its q-grams with that region, all on neighbouring diagonals
(text position less item position, at most k + 1 of them). Of the q-grams at every
s-th place, s a divisor of q, an edit spoils q / s at most. These are counted in
diagonal bands of twice that width that overlap by half; bands that reach their bound,
and the bound of all q-grams, are verified by an alignment banded to the same diagonals.
Texts are compared as lower-cased words of letters and digits with single spaces.

A long item is also cut into overlapping passages, each looked for whole under its
own budget, so that a document that quotes a large part of it is found.

The benchmark is the query set: it goes to the tasks in blocks of at most
BLOCK_CHARS characters, and every block meets every row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 6
RATE = 0.15
STRIDES = (3, 2, 1)  # of the q-grams that are counted in bands; divisors of Q
PIECES = 3  # shared ones that a stride leaves at least, or else the next is taken
LEAST = 12  # shared q-grams the budget leaves at least, in an item of 36 characters or more
SHORT = 10
PASSAGE = 240
STEP = PASSAGE // 2
BLOCK_CHARS = 4_000_000
SLICE = 256
SLICE_CHARS = 1_000_000
WINDOW = 1 << 13  # characters whose hits are counted at a time, at least the longest match
DENSE = 32  # cells a hit, up to which they are counted in place
MARK = 0  # stands behind each of several texts
TABLE_BITS = 20
BREAK = r"[^\pL\pN]+"
BASE = np.uint64(0x9E3779B97F4A7C15)
CUBE = np.uint64(pow(0x9E3779B97F4A7C15, 3, 1 << 64))


def normals(texts: pa.Array) -> pa.Array:
    """Texts in lower case, with one space for all that stands between letters and digits; null as empty.

    Lower case is taken character by character, so a normal word is as long as the word itself.
    """
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), BREAK, " ")
    return pc.utf8_trim(plain, " ")


def normal(text: str | None) -> str:
    return normals(pa.array([text], pa.string()))[0].as_py()


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point the one that stands for it in the normal form: its lower case, or a space."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    # A break between letters is replaced one by one, so places are kept.
    told = pc.replace_substring_regex(pc.utf8_lower(pa.array([every], pa.large_string())), BREAK.rstrip("+"), " ")
    out = np.full(0x110000, ord(" "), np.uint32)
    out[codes(every)] = codes(told[0].as_py())
    return out


def joined(texts: pa.Array, stands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The normal forms of texts, by letters(), as code points in a row, MARK behind each, and the places of the marks."""
    texts = pc.fill_null(texts, "")
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), "\0")[0].as_py()
    c = stands[codes(f"{whole}\0")]
    c[np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1) - 1] = MARK
    blank = c == ord(" ")
    between = blank | (c == MARK)
    blank[1:] &= between[:-1]  # a space stays behind a letter only
    c = c[~blank]
    last = np.flatnonzero(c == MARK) - 1
    c = np.delete(c, last[c[last] == ord(" ")])
    return c, np.flatnonzero(c == MARK)


def qgrams(c: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of all substrings of Q characters: of halves of three, put together."""
    if len(c) < Q:
        return np.empty(0, np.uint64)
    one = c.astype(np.uint64) + np.uint64(1)
    half = one[:-2] * BASE
    half += one[1:-1]
    half *= BASE
    half += one[2:]
    out = half[:-3] * CUBE
    out += half[3:]
    return out * np.uint64(0xD6E8FEB86659FD93)


def edit_budget(m: int, rate: float = RATE, q: int = Q) -> int:
    """Edits allowed for an item of m characters: the rate, but never so many that the lemma's bound falls below LEAST or a third."""
    return max(0, min(int(m * rate), (m + 1 - min(LEAST, m // 3)) // q - 1))


def counted(m: int, budget: int, q: int = Q) -> tuple[range, int]:
    """Places of the q-grams of an item of m characters that are counted in bands, and how many of them a match shares."""
    for stride in STRIDES:
        places = range(0, m + 1 - q, stride)
        if (bound := len(places) - q // stride * budget) >= PIECES:
            break
    return places, max(bound, 1)


def passages(text: str) -> list[str]:
    """Overlapping passages of a long text, the last one at its end; none where the whole with its budget covers as much."""
    if len(text) * (1 - RATE) <= PASSAGE:
        return []
    last = len(text) - PASSAGE
    return [text[at : at + PASSAGE] for at in [*range(0, last, STEP), last]]


@dataclass(frozen=True)
class Items:
    """A block of items and the inverted index of their counted q-grams; the units looked for are the items, then their passages."""

    ids: tuple[int, ...]
    texts: tuple[str, ...]  # of the units, as all up to budget
    owner: np.ndarray  # number of the item
    length: np.ndarray
    budget: np.ndarray
    bound: np.ndarray  # counted q-grams that a match shares at least
    every: tuple[tuple[np.ndarray, np.ndarray], ...]  # all q-grams of a unit, sorted, and their places
    grams: np.ndarray  # sorted distinct
    starts: np.ndarray  # into the two below, one more than grams
    item: np.ndarray
    at: np.ndarray
    table: np.ndarray  # by the upper bits of a gram the number of the first with them, -1 if none
    crowded: np.ndarray  # whether the next gram has the same upper bits
    short: tuple[int, ...]  # items of fewer than SHORT characters, looked for as they are
    letters: np.ndarray  # made once, on the driver

    @cached_property
    def plan(self) -> Plan:
        longest, half = int(self.length.max(initial=0)), self.budget + 1
        step, over = max(WINDOW, longest), longest + int(self.budget.max(initial=0))
        held = (longest + step + over) // half + 3
        base = np.cumsum(held) - held
        slope = (1.0 / half)[self.item]
        offset = (longest - self.at + 0.5) * slope + base[self.item] + 1
        unit = np.repeat(np.arange(len(held), dtype=np.int32), held)
        return Plan(longest, step, over, half, self.bound, base, unit, self.bound[unit], int(held.sum()), slope, offset)


@dataclass(frozen=True)
class Plan:
    """How the bands of one window of text are numbered.

    A unit's bands are neighbouring cells, with an empty one on both sides; a posting hit at position x
    of the window lies in cell floor(x * slope + offset).
    """

    longest: int
    step: int
    over: int
    half: np.ndarray  # a band's width by unit
    bound: np.ndarray
    base: np.ndarray  # a unit's first cell, the empty one
    unit: np.ndarray  # by cell
    least: np.ndarray  # a unit's bound, by cell
    held: int  # number of cells
    slope: np.ndarray  # by posting
    offset: np.ndarray


def indexed(items: list[tuple[int, str | None]]) -> Items:
    pairs = [(i, t) for i, text in items if (t := normal(text))]
    cut = [(i, t) for i, (_, whole) in enumerate(pairs) for t in passages(whole)]
    texts = tuple([t for _, t in pairs] + [t for _, t in cut])
    owner = np.array([*range(len(pairs)), *(i for i, _ in cut)], np.int64)
    length = np.array([len(t) for t in texts], np.int64)
    budget = np.array([edit_budget(len(t)) for t in texts], np.int64)
    every = [qgrams(codes(t if len(t) >= SHORT else "")) for t in texts]
    told = [counted(len(t), int(k)) for t, k in zip(texts, budget)]
    bound = np.array([least for _, least in told], np.int64)
    found = [g[:: places.step] for g, (places, _) in zip(every, told)]
    all_grams = np.concatenate([np.empty(0, np.uint64), *found])
    item = np.repeat(np.arange(len(texts)), [len(g) for g in found]).astype(np.int64)
    at = np.concatenate([np.empty(0, np.int64), *(np.arange(len(g)) * places.step for g, (places, _) in zip(found, told))]).astype(np.int64)
    order = np.argsort(all_grams, kind="stable")
    grams, first = np.unique(all_grams[order], return_index=True)
    top = (grams >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    table = np.full(1 << TABLE_BITS, -1, np.int32)
    table[top[::-1]] = np.arange(len(grams) - 1, -1, -1)
    crowded = np.append(top[:-1] == top[1:], False) if len(grams) else np.zeros(0, np.bool_)
    short = tuple(i for i, t in enumerate(texts) if len(t) < SHORT)
    ids = tuple(i for i, _ in pairs)
    return Items(ids, texts, owner, length, budget, bound, tuple((g[o], o) for g in every for o in [np.argsort(g, kind="stable")]), grams, np.append(first, len(order)), item[order].astype(np.int32), at[order].astype(np.int32), table, crowded, short, letters())


def banded(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int] | None:
    """(edits, end) of the best alignment of the whole item within text, on the diagonals low..high; None above `most`."""
    pad, far = -min(low, 0), np.uint32(0xFFFFFFFF)
    width = high - low + 1
    padded = np.full(pad + max(len(text), high + len(item) + 1) + width, far, np.uint32)
    padded[pad : pad + len(text)] = text
    limit = most + 1
    offsets = np.arange(width)
    starts = offsets + low  # text position at item position 0
    row = np.where((starts >= 0) & (starts <= len(text)), 0, limit).astype(np.int64)
    for i, ch in enumerate(item):
        at = pad + low + i
        same = padded[at : at + width] == ch
        new = row + ~same
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new = np.minimum.accumulate(new - offsets) + offsets
        row = np.minimum(new, limit)
        if row.min() > most:
            return None
    ends = offsets + low + len(item)
    row[(ends < 0) | (ends > len(text))] = limit
    best = int(row.argmin())
    return (int(row[best]), int(ends[best])) if row[best] <= most else None


def _hits(c: np.ndarray, index: Items) -> tuple[np.ndarray, np.ndarray]:
    """(position, number of the gram) wherever a q-gram of the index begins."""
    g = qgrams(c)
    first = index.table[(g >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
    maybe = np.flatnonzero(first >= 0)
    g, number = g[maybe], first[maybe]
    hit = index.grams[number] == g
    # Where the upper bits of several grams are the same, the others are searched for.
    rest = np.flatnonzero(~hit & index.crowded[number])
    if len(rest):
        found = np.searchsorted(index.grams, g[rest])
        found[found == len(index.grams)] = 0
        number[rest] = found
        hit[rest] = index.grams[found] == g[rest]
    return maybe[hit], number[hit]


def _bands(c: np.ndarray, index: Items) -> set[tuple[int, int]]:
    """(unit, lowest diagonal) of the bands, twice the lemma's width, that reach its bound.

    Only a window is held at a time. Windows overlap by the longest match, so each match lies in one.
    """
    out: set[tuple[int, int]] = set()
    p, of_gram = index.plan, np.diff(index.starts)
    for start in range(0, len(c) if len(index.grams) else 0, p.step):
        at, place = _hits(c[start : start + p.step + p.over], index)
        counts = of_gram[place]
        flat = np.repeat(index.starts[place] - np.cumsum(counts) + counts, counts)
        flat += np.arange(len(flat))
        at = np.repeat(at, counts)
        cell = (at * p.slope[flat] + p.offset[flat]).astype(np.int64)
        cells, live, numbers = _reached(cell, p)
        if not len(cells):
            continue
        units = p.unit[cells]
        low = (cells - p.base[units] - 1) * p.half[units]
        place = index.at[flat[live]]
        kept = _narrow(numbers, low, p.half[units], p.bound[units], at[live] + p.longest - place, place)
        out.update(zip(units[kept].tolist(), (low[kept] + (start - p.longest)).tolist()))
    return out


def _shared(c: np.ndarray, index: Items, u: int, low: int) -> bool:
    """Whether the unit shares as many of all its q-grams with a band as the lemma asks for, within little more than its width."""
    half, m = int(index.budget[u]) + 1, int(index.length[u])
    grams, places = index.every[u]
    start = max(low, 0)
    g = qgrams(c[start : max(low + 2 * half + m, 0)])
    first = np.searchsorted(grams, g)
    hit = np.flatnonzero(grams[np.minimum(first, len(grams) - 1)] == g)
    least = m + 1 - Q * half
    if len(hit) < least:
        return False
    first = first[hit]
    counts = np.searchsorted(grams, g[hit], side="right") - first
    of = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    at = places[of]
    inside, quarter = np.repeat(hit, counts) + (start - low) - at, -(-half // 4)
    for j in range(4):
        seen = np.zeros(m, np.bool_)
        seen[at[(inside >= j * quarter) & (inside < (j + 1) * quarter + half)]] = True
        if np.count_nonzero(seen) >= least:
            return True
    return False


def _reached(cell: np.ndarray, p: Plan) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The cells that, with the next one, hold as many hits as their unit's bound, the hits in them, and for each
    of these which of them its own cell and the one before are, -1 for none."""
    dense = p.held <= DENSE * len(cell)
    if dense:
        n = np.bincount(cell, minlength=p.held)
        n[:-1] += n[1:]
        cells = np.flatnonzero(n >= p.least)
    else:  # many units and few hits
        cells, both = np.unique(np.concatenate([cell, cell - 1]), return_counts=True)
        cells = cells[both >= p.least[cells]]
    if not len(cells):
        return cells, cells, []
    if dense:
        hot = np.zeros(p.held, np.bool_)
        hot[cells] = hot[cells + 1] = True
        live = np.flatnonzero(hot[cell])
        of = np.full(p.held, -1, np.int32)
        of[cells] = np.arange(len(cells), dtype=np.int32)
        return cells, live, [of[cell[live]], of[cell[live] - 1]]
    ends = np.append(cells, -1)
    numbers = [np.where(ends[k := np.searchsorted(cells, x)] == x, k, -1) for x in (cell, cell - 1)]
    live = np.flatnonzero((numbers[0] >= 0) | (numbers[1] >= 0))
    return cells, live, [x[live] for x in numbers]


def _narrow(numbers: list[np.ndarray], low: np.ndarray, half: np.ndarray, bound: np.ndarray, diagonal: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which bands (from diagonal low on) reach the bound by different item positions within little more than the lemma's width.

    `numbers` are the bands each hit counts in, -1 for none. A match's diagonals, half in number, lie in one of four
    windows that are wider by a quarter.
    """
    windows, places = [], []
    sides = [np.flatnonzero(number >= 0) for number in numbers]
    k = np.concatenate([number[hit] for number, hit in zip(numbers, sides)]).astype(np.int64)
    hit = np.concatenate(sides)
    quarter = -(-half // 4)
    inside = diagonal[hit] - low[k]
    # Each window lies in five neighbouring quarters; most bands reach the bound in none.
    n = np.bincount(8 * k + inside // quarter[k], minlength=8 * len(low)).reshape(-1, 8)
    most = np.max([n[:, j : j + 5].sum(axis=1) for j in range(4)], axis=0)
    some = np.flatnonzero((most >= bound)[k])
    k, inside, place = k[some], inside[some], at[hit[some]]
    for j in range(4):
        of = (inside >= j * quarter[k]) & (inside < (j + 1) * quarter[k] + half[k])
        windows.append(4 * k[of] + j)
        places.append(place[of])
    window, place, least = np.concatenate(windows), np.concatenate(places), np.repeat(bound, 4)
    # Positions are told apart only where all hits together reach the bound.
    left = (np.bincount(window, minlength=len(least)) >= least)[window]
    n = np.bincount(np.unique(window[left] << 40 | place[left]) >> 40, minlength=len(least))
    return (n >= least).reshape(-1, 4).any(axis=1)


Leak = tuple[int, int, int, int, int]  # row of the slice, item number, start, end, edits


def leaks(texts: pa.Array, index: Items) -> list[Leak]:
    """The best match of every item in every text of a slice, at most one per text and item; places are of the normal form.

    A whole item goes before a passage; the fewest edits, then the first place. Only texts with a
    band that reaches its bound become Python strings.
    """
    out: dict[tuple[int, int], tuple[bool, int, int, int]] = {}
    whole, ends = joined(texts, index.letters)
    starts = np.append(0, ends[:-1] + 1)
    text = lru_cache(maxsize=SLICE)(lambda r: whole[starts[r] : ends[r]].tobytes().decode("utf-32-le"))
    for u, low in sorted(_bands(whole, index)):
        if not _shared(whole, index, u, low):
            continue
        i = int(index.owner[u])
        half = int(index.budget[u]) + 1
        high = low + 2 * half - 1
        # The band names its text; a band over a border may belong to either side.
        first = int(np.searchsorted(ends, max(low, 0)))
        last = int(np.searchsorted(ends, max(high, 0) + int(index.length[u])))
        for r in range(first, min(last, len(texts) - 1) + 1):
            start = int(starts[r])
            if u == i or (r, i) not in out or out[r, i][0]:
                _better(out, (r, i), u != i, _verified(text(r), index, u, low - start, high - start))
    for r in range(len(texts)) if index.short else ():
        spaced = f" {text(r)} "
        for i in index.short:
            if (p := spaced.find(f" {index.texts[i]} ")) >= 0:
                _better(out, (r, i), False, (0, p, p + len(index.texts[i])))
    return [(r, i, s, e, d) for (r, i), (_, d, s, e) in sorted(out.items())]


def _better(out: dict, key: tuple[int, int], cut: bool, found: tuple[int, int, int] | None) -> None:
    if found and (key not in out or (cut, *found) < out[key]):
        out[key] = (cut, *found)


def _verified(text: str, index: Items, i: int, low: int, high: int) -> tuple[int, int, int] | None:
    """(edits, start, end) by an alignment banded to the diagonals, widened by the budget; the start from the reverse."""
    item, most = index.texts[i], int(index.budget[i])
    low, high = low - most, high + most
    if high < 0 or low > len(text):
        return None
    exact = text.find(item, max(low, 0), high + len(item))
    if exact >= 0:
        return 0, exact, exact + len(item)
    a = max(low, 0)
    window = text[a : high + len(item) + most]
    found = banded(codes(item), codes(window), low - a, high - a, most)
    if not found:
        return None
    edits, end = found
    back = banded(codes(item)[::-1], codes(window[:end])[::-1], 0, 2 * most, most)
    start = end - back[1] if back else max(0, end - len(item))
    return edits, a + start, a + end


@lru_cache(maxsize=1 << 16)
def breaks(character: str) -> bool:
    """Whether a character stands between words."""
    return pc.match_substring_regex(pa.array([character]), BREAK)[0].as_py()


def words(text: str) -> Iterator[re.Match]:
    """The words of a text, told apart as in its normal form."""
    between = "".join(re.escape(c) for c in set(text) if breaks(c))
    return re.finditer(f"[^{between}]+" if between else "(?s:.+)", text)


def original_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of the normal text as character positions of the text itself."""
    places, at = [], 0
    for m in words(text):
        width = len(m[0])
        places.append((at, at + width, m.start(), m.end()))
        at += width + 1
    lows, highs = [p[0] for p in places], [p[1] for p in places]
    out = []
    for s, e in spans:
        first = max(0, int(np.searchsorted(lows, s, side="right")) - 1)
        last = min(len(places) - 1, int(np.searchsorted(highs, e, side="left")))
        a, b = places[first], places[last]
        out.append((min(a[2] + s - a[0], a[3]), min(b[2] + max(0, e - b[0]), b[3])))
    return out


def blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items of benchmark(id, text) in blocks that the driver and each task can hold."""
    chars = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    dealt = F.pmod(F.xxhash64("id", "text"), F.lit(max(n, 1)))
    for k in range(n):
        yield indexed(sorted((r["id"], r["text"]) for r in benchmark.where(dealt == k).where("id is not null and text is not null").collect()))


def _slices(batches: Iterator[pa.RecordBatch], text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """At most SLICE rows and about SLICE_CHARS characters at a time; a longer text is alone."""
    for batch in batches:
        start, held = 0, 0
        for at, size in enumerate(pc.binary_length(batch.column(text_col)).to_pylist()):
            if at > start and (at - start == SLICE or held + (size or 0) > SLICE_CHARS):
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size or 0
        if batch.num_rows > start:
            yield batch.slice(start)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(id, item_id, start, end, edits) per document and item that lies in it; positions are characters of the text.

    Of several places of an item in a document the one with the fewest edits counts, then the first. Where the
    whole item is in none, but a passage of PASSAGE characters of it is, the best passage's place and edits are told.
    Null and empty texts and items match nothing; items equal in text are all told. Texts are read whole, in
    windows; repeated rows are told each. An empty table on either side gives an empty result; other columns
    are not read.
    """
    schema = "id long, item_id long, start long, end long, edits int"
    found = None
    for index in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            index = sent.value
            for piece in _slices(batches):
                raw, ids = piece.column("text"), piece.column("id")
                rows = []
                for r, i, s, e, d in leaks(raw, index):
                    ((s, e),) = original_spans(raw[r].as_py(), [(s, e)])
                    rows.append((ids[r].as_py(), index.ids[i], s, e, d))
                columns = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "item_id", "start", "end", "edits"])

        part = docs.select("id", "text").mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows, all columns, that hold no item of benchmark(id, text), nor a passage of one.

    Null and empty texts stay; repeated rows stay or go together. With an empty benchmark every row stays.
    """
    for index in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for piece in _slices(batches, text_col):
                dirty = {r for r, *_ in leaks(piece.column(text_col), sent.value)}
                yield piece.filter(pa.array([r not in dirty for r in range(piece.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
