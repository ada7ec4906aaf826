"""Quality rules as a short-circuit cascade.

A rule rejects a text by counts taken from it. On a sample every rule is timed (its
cost) and evaluated (what it rejects); rules are then put in order, the next one always
being that which rejects most of the texts the earlier ones let pass, per cost. The
cascade is one lazy CASE: a text that one rule rejects is not looked at by later rules.
The order changes the work only; what is kept is the same under every order.

All of it is built-in column functions. Nothing leaves a row: repeated windows of words
are found by hashes within the text's own arrays.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotweave.llm.common import stored

SAMPLE_ROWS = 2000  # rows, about, on which costs and selectivities are estimated
REPEATS = 2
WINDOW = 8
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
LINE = r"[^\x20\x09-\x0D][^\n]*"  # a line with a word, from its first one on
LETTERLESS = r"(?:^|[\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]+(?=[\x20\x09-\x0D]|\z)"
BULLET = r"^[\x20\t]*[-*•]"

Measure = Callable[[str], Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, also where the body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _rest(a: Column, n: int) -> Column:
    """The array without its first n elements."""
    return F.slice(a, n + 1, F.greatest(F.size(a) - n, F.lit(0)))


def repeated_words(words: Column) -> Column:
    """Words of an array that lie in windows of WINDOW words which the array holds at least twice.

    Windows are compared by 64-bit hashes. Only arrays with an equal pair of them are sorted.
    """

    def hashes(w: Column) -> Column:
        window = F.transform(w, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, WINDOW))))
        return let(window, lambda v: F.slice(v, 1, F.greatest(F.size(v) - WINDOW + 1, F.lit(0))))

    def covered(starts: Column) -> Column:
        """Words under windows that begin at the ascending places."""
        step = F.zip_with(starts, _rest(starts, 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0), lambda a, b: a + b)

    def marked(s: Column) -> Column:
        """Places of windows that equal a neighbour in the sorted (hash, place) pairs."""
        same = F.zip_with(s, _rest(s, 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        return F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda p: p.isNotNull()))))

    def repeats(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(let(pairs, marked), covered)).otherwise(0)

    return F.when(F.size(words) > WINDOW, let(hashes(words), repeats)).otherwise(0).cast("long")


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("long")


def _lines_with(text: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(F.split(text, "\n"), test)).cast("long")


def _ends(line: Column, *ends: str) -> Column:
    return reduce(or_, (line.endswith(e) for e in ends))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def measures(text: Column) -> dict[str, Column]:
    """The counts rules can ask for, each as an expression over the text; a null text counts as empty."""
    words, text = _words(text), F.coalesce(text, F.lit(""))
    return {
        "n_words": _count(text, WORD),
        "word_chars": _word_chars(words),
        "n_symbols": _count(text, SYMBOL),
        "n_dup_lines": _repeated_lines(text),
        "n_repeat_words": let(words, repeated_words),
        "n_lines": _count(text, LINE),
        "n_letterless": _count(text, LETTERLESS),
        "n_bullets": _lines_with(text, lambda s: s.rlike(BULLET)),
        "n_ellipses": _lines_with(text, lambda s: _ends(F.rtrim(s, F.lit(" \t\r")), "...", "…")),
    }


@dataclass(frozen=True)
class Rule:
    """A name and the condition under which a text is rejected, over the counts it asks for."""

    name: str
    rejects: Callable[[Measure], Column]


BASE = (
    Rule("few_words", lambda m: m("n_words") < 20),
    Rule("repeated_words", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
)
RULES = (
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 15 * m("n_words"))),
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("repeated_lines", lambda m: 2 * m("n_dup_lines") > m("n_lines")),
    Rule("letters", lambda m: 10 * m("n_letterless") > 3 * m("n_words")),
    Rule("bullets", lambda m: 10 * m("n_bullets") > 9 * m("n_lines")),
    Rule("ellipses", lambda m: 10 * m("n_ellipses") > 3 * m("n_lines")),
)


@dataclass(frozen=True)
class Estimate:
    """A rule's cost in seconds on the sample, and the share of the sample it rejects by itself."""

    name: str
    seconds: float
    rejected: float


def ordered(seconds: Sequence[float], patterns: dict[tuple[bool, ...], int]) -> list[int]:
    """The order of the rules: next comes the most rejected of what is left, per cost.

    `patterns` counts the sample's rows by which rules reject them. Ties go to the cheaper rule, then
    to the earlier one.
    """
    left, order = dict(patterns), []
    while len(order) < len(seconds):
        gain = lambda k: sum(n for p, n in left.items() if p[k])
        best = min((k for k in range(len(seconds)) if k not in order), key=lambda k: (-gain(k) / seconds[k], seconds[k], k))
        order.append(best)
        left = {p: n for p, n in left.items() if not p[best]}
    return order


def estimated(sample: DataFrame, rules: Sequence[Rule], measure: Measure) -> tuple[list[Rule], list[Estimate]]:
    """The rules in cascade order, with the estimates they were ordered by (in the given order).

    Without rows the given order stays.
    """
    flags = [F.coalesce(r.rejects(measure), F.lit(False)).alias(f"r{k}") for k, r in enumerate(rules)]
    names = [f"r{k}" for k in range(len(rules))]
    patterns = {tuple(r[:-1]): r[-1] for r in sample.select(*flags).groupBy(*names).count().collect()} if rules else {}
    total = sum(patterns.values())
    if not total:
        return list(rules), []

    def seconds(flag: Column) -> float:
        taken = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            sample.agg(F.count_if(flag)).collect()
            taken.append(time.perf_counter() - start)
        return min(taken)

    bare = seconds(F.isnull(F.col("text")))
    cost = [max(seconds(f) - bare, 1e-3) for f in flags]
    told = [Estimate(r.name, c, sum(n for p, n in patterns.items() if p[k]) / total) for k, (r, c) in enumerate(zip(rules, cost))]
    return [rules[k] for k in ordered(cost, patterns)], told


def drawn(docs: DataFrame, rows: int) -> DataFrame:
    """About that many rows. Each is drawn by itself, so a document repeated many times has its share only."""
    n = docs.count()
    return docs.sample(min(1.0, rows / n), seed=1) if n else docs


def first_rejection(rules: Sequence[Rule], measure: Measure) -> Column:
    """The name of the first rule, in this order, that rejects the row; null if none does. Later ones are not evaluated."""
    if not rules:
        return F.lit(None).cast("string")
    chain = F.when(rules[0].rejects(measure), F.lit(rules[0].name))
    for rule in rules[1:]:
        chain = chain.when(rule.rejects(measure), F.lit(rule.name))
    return chain


def accepted(docs: DataFrame, rules: Sequence[Rule] = BASE + RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs(text, ...), all columns, that no rule rejects.

    Every count is taken from the text when a rule first asks for it. A null or empty text has no words
    and fails the base rules. Repeated rows share their verdict and stay repeated; an empty table stays
    empty; columns named like a count are not read.
    """
    expressions = measures(F.col("text"))
    sample = stored(drawn(docs.select("text"), sample_rows), "quality-sample")
    order, _ = estimated(sample, rules, expressions.__getitem__)
    return docs.where(first_rejection(order, expressions.__getitem__).isNull())


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) per row of docs(id, text, ...).

    The counts are taken of every text, whatever its verdict; the cascade runs over the rows that pass the
    base rules and takes further counts only when a rule asks for them. A null or empty text counts zero
    everywhere and fails the base. Texts of any length are one row's arrays. Rows are independent: repeated
    or null ids change nothing, an empty table gives an empty result, other columns are not returned.
    """
    expressions = measures(F.col("text"))
    measure = (expressions | {c: F.col(c) for c in COUNTS}).__getitem__
    failed = F.col("base_failed")

    def counted(df: DataFrame) -> DataFrame:
        of_words = lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), _word_chars(w).alias("word_chars"), repeated_words(w).alias("n_repeat_words")
        )
        split = let(_words(F.col("text")), of_words)  # the words are taken once for all three
        told = df.select(*df.columns, split.alias("w"), expressions["n_symbols"].alias("n_symbols"), expressions["n_dup_lines"].alias("n_dup_lines"))
        told = told.select(*df.columns, "w.*", "n_symbols", "n_dup_lines")
        return told.withColumn("base_failed", BASE[0].rejects(measure) | BASE[1].rejects(measure))

    sample = stored(counted(drawn(docs.select("text"), sample_rows)).where(~failed), "quality-sample")
    order, _ = estimated(sample, rules, measure)
    kept = F.when(failed, False).otherwise(first_rejection(order, measure).isNull())
    return counted(docs.select("id", "text")).select("id", *COUNTS, failed, kept.alias("kept"))
