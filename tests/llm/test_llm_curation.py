"""Quality rules, centroid clustering and fill-in-middle, against brute force and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotweave.llm import centroids, fill_middle, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def frame(spark, rows, ddl="id long, text string"):
    return spark.createDataFrame(rows, ddl)


def random_text(r, words, vocabulary=12, gaps=(" ", "  ", "\n", "\t", " \x0b", "\n\n")):
    letters = ["a", "be", "é", "der", "x1", "#", "1.", "…", "wörd", "*"] + ["w%d" % i for i in range(vocabulary)]
    return "".join(r.choice(letters) + r.choice(gaps) for _ in range(words))


# --- quality rules ----------------------------------------------------------


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    times = Counter(windows)
    places = {i + k for i, g in enumerate(windows) if times[g] > 1 for k in range(8)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    dup = len(lines) - len(set(lines))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(places), lines, w


def verdict(text):
    n, chars, symbols, dup, repeat, lines, w = counts(text)
    base = n < 20 or 100 * repeat > 30 * n
    letterless = sum(not any(c.isalpha() for c in x) for x in w)
    bullets = sum(bool(re.match(r"[\x20\t]*[-*•]", s)) for s in lines)
    dots = sum(s.rstrip(" \t\r").endswith(("...", "…")) for s in lines)
    bad = chars < 2 * n or chars > 15 * n or 10 * symbols > n or 2 * dup > len(lines)
    bad = bad or 10 * letterless > 3 * n or 10 * bullets > 9 * len(lines) or 10 * dots > 3 * len(lines)
    return base, not (base or bad)


def quality_texts():
    r = random.Random(5)
    texts = [random_text(r, r.randint(0, 60), r.choice([1, 3, 400])) for _ in range(120)]
    words = ["word%d" % i for i in range(400)]
    good = " ".join(words[:30])
    texts += [good, good + "\n" + good, "\n".join(f"- {w} is" for w in words[:20]), "\n".join(f"{w} is so ...  \r" for w in words[:20])]
    texts += [f"{good} | {' | '.join(words[:8])}", "1 2 3 4 5 6 7 8 9 " + good, " ".join(["abcdefghijklmnopqrs"] + [w * 4 for w in words[:30]])]
    texts += [None, "", " \n\t\n", "x" * 100_000, " ".join(r.choices(words, k=30_000)), " ".join(words[:9] * 2)]
    return texts


def test_quality_counts_and_verdicts(spark):
    texts = quality_texts()
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[121])]
    told = quality.judged(frame(spark, rows)).collect()
    assert len(told) == len(rows)
    by_id = {r["id"]: r for r in told}
    for i, t in rows[: len(texts)]:
        n, chars, symbols, dup, repeat, *_ = counts(t)
        got = by_id[i]
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == (n, chars, symbols, dup, repeat), t
        assert (got["base_failed"], got["kept"]) == verdict(t), t
    assert {r["kept"] for r in told} == {True, False}


def test_accepted_takes_the_same_rows_in_any_order(spark, monkeypatch):
    texts = quality_texts()
    docs = frame(spark, [(i, t, "n", 1) for i, t in enumerate(texts)], "id long, text string, n_words string, kept int")
    want = sorted(i for i, t in enumerate(texts) if verdict(t)[1])
    for flip in (False, True):
        if flip:
            monkeypatch.setattr(quality, "ordered", lambda seconds, patterns: list(range(len(seconds)))[::-1])
        got = quality.accepted(docs)
        assert got.columns == docs.columns
        assert sorted(r["id"] for r in got.collect()) == want


def test_order_is_rejection_per_cost():
    # The first rule rejects most; what it leaves decides about the second and third.
    patterns = {(True, True, False): 50, (False, False, True): 10, (True, False, False): 20, (False, False, False): 20}
    assert quality.ordered([1.0, 0.1, 1.0], patterns) == [1, 0, 2]
    assert quality.ordered([1.0, 5.0, 1.0], patterns) == [0, 2, 1]
    assert quality.ordered([1.0, 1.0], {(False, False): 3}) == [0, 1]


def test_later_rules_are_not_evaluated(spark):
    boom = quality.Rule("boom", lambda m: F.raise_error(F.lit("evaluated")).cast("boolean"))
    all_ = quality.Rule("all", lambda m: F.col("text").isNotNull())
    df = frame(spark, [(1, "a"), (2, "b")])
    assert [r[0] for r in df.select(quality.first_rejection([all_, boom], None)).collect()] == ["all", "all"]


def test_quality_empty_table_and_python_free_plan(spark):
    empty = frame(spark, [])
    assert quality.judged(empty).collect() == [] and quality.accepted(empty).collect() == []
    df = quality.judged(frame(spark, [(1, "a b")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# --- centroids --------------------------------------------------------------


def lloyd(vectors, clusters=40, rounds=5):
    usable = [(i, v) for i, v in vectors if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    q = [[int(np.floor(256 * float(np.float32(x)))) for x in v] for _, v in usable]
    order = sorted(range(len(q)), key=lambda n: (hashlib.sha256(f"2:{'' if usable[n][0] is None else usable[n][0]}".encode()).hexdigest(), q[n]))
    at = [q[n] for n in order[:clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for k in range(rounds + 1):
        of = [min(range(len(at)), key=lambda c: (far(v, at[c]), c)) for v in q]
        if k < rounds:
            for c in range(len(at)):
                mine = [v for v, o in zip(q, of) if o == c]
                if mine:
                    at[c] = [sum(x) // len(mine) for x in zip(*mine)]
    rows = []
    for (i, _), v, c in zip(usable, q, of):
        rows.append((i, c, far(v, at[c]), hashlib.sha256(",".join(map(str, at[c])).encode()).hexdigest()))
    return rows


def checked(spark, vectors):
    df = spark.createDataFrame([(i, v, 7) for i, v in vectors], "id long, vector array<float>, cluster int")
    got = centroids.clustered(df).collect()
    want = lloyd(vectors)
    assert sorted((str(r["id"]), r["cluster"], r["distance"], r["centroid_sha256"]) for r in got) == sorted((str(i), *x) for i, *x in want)
    inertia = sum(w[2] for w in want)
    for r in got:
        assert r["inertia"] == inertia
        assert r["cluster_inertia"] == sum(w[2] for w in want if w[1] == r["cluster"])
    return got


def test_clusters_equal_lloyd_with_ties_and_odd_rows(spark):
    r = random.Random(3)
    few = [[r.choice([-0.5, 0.0, 0.25]) for _ in range(64)] for _ in range(30)]  # coarse: many equal distances
    vectors = [(i, r.choice(few)) for i in range(150)] + [(500 + i, [r.gauss(0, 0.3) for _ in range(64)]) for i in range(150)]
    vectors += [(7, few[0]), (7, few[0]), (None, few[1]), (900, None), (901, []), (902, [0.1] * 63), (903, [0.1] * 63 + [None])]
    vectors += [(904, [0.1] * 63 + [float("nan")]), (905, [float("inf")] + [0.1] * 63), (906, [30_000.0] + [0.1] * 63)]
    checked(spark, vectors)


def test_fewer_rows_than_clusters_and_none(spark):
    assert len(checked(spark, [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.25] * 64)])) == 3
    assert len(checked(spark, [(1, [0.5] * 64)])) == 1
    assert centroids.clustered(spark.createDataFrame([], "id long, vector array<float>")).collect() == []


def test_distances_beyond_a_long_raise(spark):
    df = spark.createDataFrame([(1, [1e12] * 64), (2, [-1e12] * 64)], "id long, vector array<double>")
    with pytest.raises(ArithmeticError):
        centroids.clustered(df).collect()


def test_bounds_spare_distances():
    r = np.random.default_rng(1)
    middle = r.integers(-300, 300, (40, 64))
    rows = middle[r.integers(0, 40, 4000)] + r.integers(-30, 30, (4000, 64))
    at = rows[:40].copy()
    state, before, spent = None, None, []
    for _ in range(6):
        state, n = centroids.assigned(rows, centroids.Centroids.of(at, before), state)
        brute = np.stack([centroids.squared(rows, c) for c in at]).argmin(axis=0)
        assert (state.cluster == brute).all()
        spent.append(n)
        before, at = at, np.stack([rows[state.cluster == c].sum(axis=0) // max((state.cluster == c).sum(), 1) if (state.cluster == c).any() else at[c] for c in range(40)])
    assert spent[-1] < 0.1 * rows.shape[0] * 40 and spent[0] < rows.shape[0] * 40


# --- fill in the middle -----------------------------------------------------


def by_units(key, text):
    text = text or ""
    u = UNIT.findall(text)
    h = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(u), "plain", None, None, text
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 80:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_rows():
    r = random.Random(9)
    shared = random_text(r, 3000, 400)
    texts = [None, "", " ", "\n\t ", "word", " word", "word ", "a<S>b c", "<P", "x" * 200_000, " " * 100_000, ("é" * 70_000 + " ") * 3]
    texts += [random_text(r, r.randint(1, 400), 300) for _ in range(150)]
    texts += [random_text(r, 50) + shared + random_text(r, 50) for _ in range(10)]
    texts += ["almost < P> and <S or M> " + random_text(r, 30) for _ in range(20)]
    return list(enumerate(texts)) + [(13, texts[13]), (13, texts[14]), (None, texts[15])]


def test_fill_in_middle_equals_units(spark):
    rows = fim_rows()
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "id long, text string, output string")
    told = fill_middle.transformed(df).withColumn("restored", fill_middle.restored()).collect()
    got = [(str(r["id"]), r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in told]
    assert sorted(got, key=str) == sorted(((str(i), *by_units("" if i is None else i, t)) for i, t in rows), key=str)
    assert sorted((str(r["id"]), r["restored"]) for r in told) == sorted((str(i), t or "") for i, t in rows)
    assert {r["form"] for r in told} == {"plain", "psm", "spm"}
    assert fill_middle.transformed(df.limit(0)).collect() == []


def test_units_at_every_place():
    r = random.Random(2)
    for text in [random_text(r, 300), "a" * 3000 + " b  " + "c" * 3000, " " * 70_000 + "a " * 9, "ab " * 40_000]:
        raw, u = text.encode(), UNIT.findall(text)
        units = fill_middle.Units(raw, fill_middle.Summaries())
        assert units.n == len(u)
        assert units.ends[-1] == len(raw) and all(b - a <= fill_middle.LONGEST for a, b in zip([0, *units.ends], units.ends))
        at, ends = 0, [0]
        for x in u:
            at += len(x.encode())
            ends.append(at)
        for k in {0, 1, 2, len(u) // 2, len(u) - 1, len(u), *r.choices(range(len(u)), k=40)}:
            assert units.end_of(k) == ends[k]


def test_shared_passages_are_summed_up_once_and_content_is_compared():
    r = random.Random(4)
    shared = random_text(r, 20_000, 400).encode()
    cache = fill_middle.Summaries()
    fill_middle.Units(b"one start " + shared, cache)
    chunks, before = len(cache.known), cache.hits
    fill_middle.Units(b"quite another start of it " + shared, cache)
    assert len(cache.known) < 1.2 * chunks and cache.hits - before > 0.8 * chunks
    chunk = b"some words here"
    key = fill_middle.zlib.crc32(chunk) << 32 | len(chunk)
    cache.known[key] = b"other words her", fill_middle.Summary(99, True, True)
    assert cache.of(chunk).words == 3
    small = fill_middle.Summaries(most=1000)
    for k in range(100):
        small.of(b"chunk %d " % k * 10)
    assert small.held <= 1000 and small.held == sum(len(c) for c, _ in small.known.values())


def test_borders_depend_on_content_only():
    r = random.Random(6)
    text = random_text(r, 30_000, 400).encode()
    base = fill_middle.borders(text)
    moved = {b - 5 for b in fill_middle.borders(b"12345" + text)}
    assert len(set(base) & moved) > 0.9 * len(base)
    big = text * 12  # across blocks
    assert len(big) > fill_middle.BLOCK and {b for b in fill_middle.borders(big) if b <= len(text)} >= set(base[:-1])
