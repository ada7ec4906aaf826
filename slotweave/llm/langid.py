"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A
word's probability is the sum over all its segmentations into pieces (the
forward algorithm); a text's is the product over its words. The probabilities
are learned by expectation maximisation on the word counts of a sample of
labelled documents, about SAMPLE per language, chosen by a hash of id and text.
"""

from __future__ import annotations

import logging
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

MODEL_FILE = "piece_bpe_32k.model"
SAMPLE = 200
LONGEST = 64  # characters: longer words are learned from in parts
ROUNDS = 3
SMOOTHING = 0.02
WORD = re.compile(r"[^\W\d_]+")
MARK = "▁"
UNDETERMINED = "und"
CACHE = 400_000
SLICE = 512


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL_FILE)


@lru_cache
def vocabulary(path: str) -> dict[str, int]:
    """Piece -> row. Rows are the vocabulary's ids; row of the unknown piece stands for any other character."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
    return {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not special(i)}


@lru_cache
def unknown_row(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).unk_id()


@lru_cache
def longest(path: str) -> int:
    return max(map(len, vocabulary(path)))


def words(text: str | None) -> Counter:
    """Lower-cased words of letters, each with the mark of a word's start, and their counts."""
    found = Counter(WORD.findall((text or "").lower()))
    return Counter({MARK + w: n for w, n in found.items() if any(map(str.isalpha, w))})


def _spans(word: str, vocab: dict[str, int], unk: int, width: int) -> list[list[tuple[int, int]]]:
    """For every end the (start, row) of the pieces that end there."""
    out = []
    for j in range(1, len(word) + 1):
        found = [(i, r) for i in range(max(0, j - width), j) if (r := vocab.get(word[i:j])) is not None]
        if not found or found[-1][0] != j - 1:
            found.append((j - 1, unk))
        out.append(found)
    return out


def expectation_maximisation(counts: dict[str, int], path: str, rounds: int = ROUNDS) -> dict[int, float]:
    """Expected piece counts (row -> count) of one language's words after some rounds."""
    vocab, unk, width = vocabulary(path), unknown_row(path), longest(path)
    size = len(vocab) + 1
    parts = ((w[i : i + LONGEST], n) for w, n in sorted(counts.items()) for i in range(0, len(w), LONGEST))
    prepared = [(n, _spans(w, vocab, unk, width)) for w, n in parts]
    p: dict[int, float] = {}
    start = 1.0 / size
    for _ in range(rounds):
        expected: dict[int, float] = defaultdict(float)
        for n, spans in prepared:
            last = len(spans)
            forward = [1.0] + [0.0] * last
            for j, found in enumerate(spans, 1):
                forward[j] = sum(forward[i] * p.get(r, start) for i, r in found)
            total = forward[last]
            backward = [0.0] * last + [1.0]
            for j in range(last, 0, -1):
                b = backward[j]
                for i, r in spans[j - 1]:
                    step = p.get(r, start) * b
                    expected[r] += n * forward[i] * step / total
                    backward[i] += step
        mass = sum(expected.values()) + SMOOTHING * size
        p = {r: (c + SMOOTHING) / mass for r, c in expected.items()}
        start = SMOOTHING / mass
    return dict(expected)


@dataclass(frozen=True)
class LanguageModel:
    path: str
    langs: tuple[str, ...]
    prior: np.ndarray  # log share of each language
    probability: np.ndarray  # piece row x language


class Scorer:
    """Log probabilities of words under every language, remembered up to CACHE words."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.vocab, self.unk, self.width = vocabulary(model.path), unknown_row(model.path), longest(model.path)
        self.seen: dict[str, int] = {}
        self.scores = np.zeros((1024, len(model.langs)))

    def _forward(self, group: list[str]) -> np.ndarray:
        """Words of one length: the window of forward sums, rescaled now and then against underflow."""
        p, get = self.model.probability, self.vocab.get
        n, langs = len(group), len(self.model.langs)
        none = len(p) - 1  # a row of zeros
        window: list[np.ndarray] = [np.ones((n, langs))]
        scale = np.zeros((n, langs))
        for j in range(1, len(group[0]) + 1):
            total = np.zeros((n, langs))
            for back, at in enumerate(reversed(window), 1):
                i = j - back
                if back == 1:
                    rows = [get(w[i:j], self.unk) for w in group]
                else:
                    rows = [get(w[i:j], none) for w in group]
                    if rows.count(none) == n:
                        continue
                total += at * p[rows]
            window.append(total)
            if len(window) > self.width:
                window.pop(0)
            if j % 8 == 0:
                scale += np.log(total)
                window = [x / total for x in window]
        return scale + np.log(window[-1])

    def rows(self, found: list[Counter]) -> list[np.ndarray]:
        """For every counter the summed log probabilities per language."""
        seen = self.seen
        if len(seen) > CACHE:
            seen.clear()
        fresh: dict[int, list[str]] = defaultdict(list)
        for w in {w for c in found for w in c if w not in seen}:
            fresh[len(w)].append(w)
        for group in fresh.values():
            for at in range(0, len(group), 4096):
                part = group[at : at + 4096]
                scores = self._forward(part)
                first = len(seen)
                while first + len(part) > len(self.scores):
                    self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
                self.scores[first : first + len(part)] = scores
                seen.update(zip(part, range(first, first + len(part))))
        out = []
        for c in found:
            ids = np.fromiter(map(seen.__getitem__, c), np.int64, len(c))
            out.append(np.fromiter(c.values(), np.float64, len(c)) @ self.scores[ids] if len(c) else None)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        for total in self.rows([words(t) for t in texts]):
            if total is None or not self.model.langs:
                out.append((UNDETERMINED, 0.0))
                continue
            total = total + self.model.prior
            best = int(total.argmax())
            out.append((self.model.langs[best], float(1 / np.exp(total - total[best]).sum())))
        return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def train(labelled: DataFrame, sample: int = SAMPLE, path: str | None = None) -> LanguageModel:
    """A model from labelled(id, text, lang); rows without text or language teach nothing.

    At most about `sample` documents a language are read (all, if there are fewer). Of a language that the
    draw misses, as when one text is all it has, the `sample` rows with the least hashes are read. One without
    any word can't be learned; it is told in the log.
    """
    path = path or model_path()
    known = labelled.select("id", "text", "lang").where("text is not null and lang is not null")
    sizes = known.groupBy("lang").count().collect()
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, sample / r["count"]))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit("langid"), "id", "text"), F.lit(1 << 20)) / float(1 << 20)

    def counted(batches):
        for piece in _slices(batches):
            total: dict[str, Counter] = defaultdict(Counter)
            for text, lang in zip(piece.column("text").to_pylist(), piece.column("lang").to_pylist()):
                total[lang].update(words(text))
            flat = [(lang, w, n) for lang, c in total.items() for w, n in c.items()]
            lang, word, n = zip(*flat) if flat else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())], ["lang", "word", "n"]
            )

    def fitted(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        counts = dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist()))
        expected = sorted(expectation_maximisation(counts, path).items())
        rows, values = zip(*expected) if expected else ((), ())
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * len(rows), pa.string()),
                "row": pa.array(rows, pa.int32()),
                "expected": pa.array(values, pa.float64()),
            }
        )

    def learn(rows: DataFrame) -> list[Row]:
        """Expected counts: at most the vocabulary's size per language comes to the driver."""
        counted_words = rows.select("text", "lang").mapInArrow(counted, "lang string, word string, n long")
        counts = counted_words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
        return counts.groupBy("lang").applyInArrow(fitted, "lang string, row int, expected double").collect()

    learned = learn(known.where(draw < share))
    for lang in sorted({r["lang"] for r in sizes} - {r["lang"] for r in learned}):
        learned += learn(known.where(F.col("lang") == lang).orderBy(draw).limit(sample))
    if missing := sorted({r["lang"] for r in sizes} - {r["lang"] for r in learned}):
        logger.warning("no labelled document has a word of %s", ", ".join(missing))
    langs = tuple(sorted({r["lang"] for r in learned}))
    size = max([*vocabulary(path).values(), unknown_row(path)]) + 2
    table = np.full((size, len(langs)), SMOOTHING)
    for r in learned:
        table[r["row"], langs.index(r["lang"])] += r["expected"]
    table[-1] = 0.0
    table /= table.sum(axis=0) if langs else 1.0
    documents = {r["lang"]: r["count"] for r in sizes}
    prior = np.array([math.log(documents[x] / sum(documents[y] for y in langs)) for x in langs])
    return LanguageModel(path, langs, prior, table)


def identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(id, lang_pred, score) of docs(id, text). A text that is null or has no letter is `und` with score 0.

    The score is the posterior share of the predicted language; ties go to the first language by code point.
    Texts are read whole, whatever their length. Repeated rows get equal results each; a null id stays null, an
    empty table stays empty, and other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = _scorer(sent.value)
        for piece in _slices(batches):
            told = scorer.predict(piece.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array([x for x, _ in told], pa.string()), pa.array([s for _, s in told], pa.float64())],
                ["id", "lang_pred", "score"],
            )

    return docs.select("id", "text").mapInArrow(run, "id long, lang_pred string, score double")


def recognised(docs: DataFrame, model: LanguageModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, all columns, whose language is determined with a score of at least `least`.

    Null and letterless texts go; repeated rows stay or go together. Columns may bear any names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = _scorer(sent.value)
        for piece in _slices(batches):
            told = scorer.predict(piece.column(text_col).to_pylist())
            yield piece.filter(pa.array([lang != UNDETERMINED and score >= least for lang, score in told], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


_LAST: list = [None, None]


def _scorer(model: LanguageModel) -> Scorer:
    """The worker's scorer for this model; its memory of words serves all tasks of the worker."""
    if _LAST[0] is not model:
        _LAST[:] = [model, Scorer(model)]
    return _LAST[1]
