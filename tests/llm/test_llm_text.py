"""Language ID, main text, token counts and lines, against brute force and on odd rows."""

import hashlib
import itertools
import math
import random
import re

import pytest

from slotweave.llm import html_text, langid, line_dedup, tokens

ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "123 !!! ²"), (None, "the words of the text"), (5, "x" * 50_000), (5, "x" * 50_000)]


# --- language ID ------------------------------------------------------------


def two_languages(n=60, seed=3):
    r = random.Random(seed)
    make = {"aa": ["the", "thing", "and", "with", "ending"], "bb": ["der", "keit", "und", "schön", "lich"]}
    rows = []
    for i in range(n):
        lang = ("aa", "bb")[i % 2]
        rows.append((i, " ".join("".join(r.choices(make[lang], k=2)) for _ in range(20)), lang))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    labelled = [*two_languages(), (1000, None, "aa"), (1001, "no label", None), (1002, "", "aa")]
    return langid.train(spark.createDataFrame(labelled, "id long, text string, lang string"), sample=100)


def test_forward_sums_all_segmentations(model):
    scorer, vocab, unk = langid.Scorer(model), langid.vocabulary(model.path), langid.unknown_row(model.path)
    for word in ("▁then", "▁zß", "▁undkeit"):
        total = [0.0] * len(model.langs)
        for cuts in itertools.product((0, 1), repeat=len(word) - 1):
            places = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
            rows = []
            for a, b in itertools.pairwise(places):
                rows.append(vocab.get(word[a:b], unk if b - a == 1 else None))
            if None not in rows:
                for k in range(len(total)):
                    total[k] += math.prod(model.probability[r, k] for r in rows)
        (got,) = scorer.rows([{word: 1}])
        assert got == pytest.approx([math.log(t) for t in total])


def test_languages_without_ids_or_of_one_text_are_learned(spark):
    rows = [(None, text, lang) for _, text, lang in two_languages(400)] + [(1, "eine einzige zeile", "cc")] * 500 + [(2, "123", "dd")]
    learned = langid.train(spark.createDataFrame(rows, "id long, text string, lang string"), sample=20)
    assert learned.langs == ("aa", "bb", "cc")


def test_probabilities_sum_to_one(model):
    assert model.probability.sum(axis=0) == pytest.approx([1.0, 1.0])


def test_languages_are_told(spark, model):
    held = two_languages(40, seed=9)
    df = spark.createDataFrame(held, "id long, text string, lang string")
    told = {r["id"]: r for r in langid.identified(df, model).collect()}
    assert all(told[i]["lang_pred"] == lang and 0.5 < told[i]["score"] <= 1 for i, _, lang in held)


def test_odd_texts(spark, model):
    df = spark.createDataFrame(ODD, "id long, text string")
    told = [(r["id"], r["lang_pred"]) for r in langid.identified(df, model).collect()]
    assert len(told) == len(ODD)
    assert {i for i, lang in told if lang == "und"} == {1, 2, 3, 4}
    extra = df.selectExpr("id", "text", "1 AS score", "'x' AS lang_pred")
    kept = langid.recognised(extra, model)
    assert kept.columns == extra.columns and kept.count() == 3
    assert langid.identified(df.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    empty = langid.train(spark.createDataFrame([], "id long, text string, lang string"))
    df = spark.createDataFrame([(1, "words")], "id long, text string")
    assert langid.identified(df, empty).first()["lang_pred"] == "und"


# --- main text --------------------------------------------------------------


def test_held_out_pages():
    model = html_text.fitted()
    right = 0
    pages = list(html_text.training_pages(120, seed=41))
    for source in pages:
        want = [t.replace(html_text.MAIN, "") for _, t, _ in html_text.parse(source).runs if html_text.MAIN in t]
        right += html_text.main_texts([source.replace(html_text.MAIN, "")], model) == ["\n".join(want)]
    assert right >= 0.93 * len(pages)


def test_decoding_is_the_best_closed_set():
    page = html_text.parse("<div>a<section>b<p>c</p></section><section>d</section></div><div>e<p>f</p></div>")
    n = len(page.tag)
    r = random.Random(5)
    for _ in range(50):
        odds = [r.uniform(-3, 3) for _ in range(n)]
        best = max(
            (
                sum(odds[i] for i in range(1, n) if kept[i - 1])
                for kept in itertools.product((0, 1), repeat=n - 1)
                if all(not kept[i - 1] or page.parent[i] == 0 or kept[page.parent[i] - 1] for i in range(1, n))
            )
        )
        kept = html_text.decoded(page, __import__("numpy").array(odds))
        assert sum(odds[i] for i in range(1, n) if kept[i]) == pytest.approx(best)
        assert all(kept[page.parent[i]] for i in range(1, n) if kept[i])


def test_markup_is_read_as_browsers_do():
    page = html_text.parse("<p>one <b>two<br>three<p>four &amp;amp; &lt;x&gt;</b><li>five<li>six<script>var a='</p>'</script> seven</li><!-- no -->&nbsp; ")
    assert [t for _, t, _ in page.runs] == ["one two three", "four &amp; <x>", "five", "six seven"]


@pytest.mark.parametrize(
    ("source", "runs"),
    [
        ("<p>one <svg/>two</p><p>three</p>", ["one two", "three"]),
        ('<p>one <svg class="x" />two</p><svg><text>no</text></svg><p>three</p>', ["one two", "three"]),
        ("<p>one <svg><g><svg><text>no</text></svg>no</g></svg>two", ["one two"]),
        ("<p>one <svg><title>no</title><foreignObject><p>no</p></foreignObject><text>no</text></svg>two", ["one two"]),
        ("<p>one <svg><path d='x'>two</p><p>three", ["one two", "three"]),
        ("<svg><path><p>one</p><p>two <svg><path/></svg>three</p>", ["one", "two three"]),
        ("<p>one <math/>two</p><p>three", ["one two", "three"]),
        ("<p>one <math><mi>x</mi><mo>=</mo><mn>1</mn></math> two", ["one x=1 two"]),
        ("<p>one <math><semantics><mi>x</mi><annotation>no</annotation></semantics></math> two", ["one x two"]),
        ("<p>one <math><mi>x</mi> two</p><p>three", ["one x two", "three"]),
        ("<p>one <noscript>two</noscript> three</p><noscript><p>four", ["one two three", "four"]),
        ("<template><p>no</p></template><p>one</p><template><p>two</p>", ["one", "two"]),
        ("<p title=it's>Main text here.</p><p>It doesn't end</p>", ["Main text here.", "It doesn't end"]),
        ('<p data-x="5" y">body text <a href="u">link</a></p>', ["body text link"]),
        ("<p title = 'a > b'>one</p><p title=\"a > b\"class='>'>two</p>", ["one", "two"]),
        ('<p title="never closed>one</p><p>two', ["one", "two"]),
        ("<p title=>one</p><p =\"x>two</p><p a='b'=c d=/e/>three</p>", ["one", "two", "three"]),
        ("<p>one</p><script>if (a<b) '</p>'", ["one"]),
    ],
)
def test_no_text_is_lost_in_odd_markup(source, runs):
    assert [t for _, t, _ in html_text.parse(source).runs] == runs


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "<div" * 2000), (5, "u", "<div>" * 3000 + "x"), (None, "u", "</p></p>text")]
    got = html_text.extracted(spark.createDataFrame(rows, "id long, url string, html string")).collect()
    assert len(got) == len(rows) and all(r["text"] is not None for r in got)
    assert next(r for r in got if r["id"] == 1)["text"] == ""


# --- token counts -------------------------------------------------------------


def test_chunks_count_like_the_whole():
    sp = tokens.processor(tokens.model_path())
    r = random.Random(2)
    texts = ["a  b" * 500, " " * 700, "▁ ▁" * 300, "a b " * 300 + " ", "é😀 " * 200, "x" * 3000, "", " ", "naïve café\n\n  9999 " * 90]
    texts += ["".join(r.choices("ab é \n7▁", k=2000)) for _ in range(20)]
    for text in texts:
        for chunk, overlap in ((40, 4), (300, 16)):
            assert tokens.count_long(sp, text, chunk, overlap) == len(sp.encode(text))


def test_token_rows(spark):
    df = spark.createDataFrame(ODD, "id long, text string")
    got = tokens.counted(df, limit=100, chunk=1000).collect()
    sp = tokens.processor(tokens.model_path())
    want = sorted((str(i), len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 100) for i, t in ODD)
    assert sorted((str(r["id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == want


# --- lines ---------------------------------------------------------------------


def brute_lines(rows):
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate({c: c + 32 for c in range(65, 91)})
    order = lambda i: (i is None, i)
    owner = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            owner[k] = min(owner.get(k, i), i, key=order)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or owner[key(x)] == i]
        out.append((str(i), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("batches", "hot"), [(1, line_dedup.HOT), (3, 12)])
def test_lines_against_brute_force(spark, monkeypatch, batches, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)  # some lines, or all of them, are hot
    r = random.Random(batches)
    stock = [f"A line number {k} of the stock" for k in range(12)] + ["short", "", "  ÉCOLE en fête  ", "ÉCOLE en FÊTE", "é" * 9, "é" * 10]
    rows = [(i, "\n".join(r.choice([str.upper, str.lower, lambda x: f" {x}\t"])(x) for x in r.choices(stock, k=r.randint(0, 8)))) for i in range(40)]
    rows += [(None, stock[0]), (None, "only the rows without an id\n" + stock[1]), (7, stock[2] + "\n" + stock[2]), (41, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    got = line_dedup.without_repeated_lines(df, batches)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((str(x["id"]), x["n_lines"], x["n_dropped"], digest(x["text"])) for x in got.collect()) == brute_lines(rows)


def test_runs_are_compacted(spark):
    with line_dedup.LineRuns(spark, fanout=2, buckets=4) as runs:
        for k in range(5):
            runs.add(spark.createDataFrame([(bytes([k]) * 16,)], "h binary"))
        assert [len(level) for level in runs.levels] == [1, 0, 1]
        assert sum(t.count() for t in runs.tables()) == 5
    assert runs.tables() == []


def test_no_lines(spark):
    assert line_dedup.without_repeated_lines(spark.createDataFrame([], "id long, text string")).count() == 0


def test_rows_without_an_id_get_only_their_own_dropped_lines(spark):
    shared = [f"a line that is shared {k}" for k in range(60)]
    rows = [(1, "\n".join(shared)), *((None, f"{line}\nits own line {k}") for k, line in enumerate(shared)), (None, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    with line_dedup.LineRuns(spark) as runs:
        dropped = runs.batch(df.selectExpr(f"coalesce(id, {line_dedup.LAST_ID}) AS id", "text"))
        assert max(r["count"] for r in dropped.groupBy("id", "row").count().collect()) == 1
    got = line_dedup.without_repeated_lines(df, batches=2).collect()
    assert sorted(r["text"] for r in got) == sorted(["\n".join(shared), "", *(f"its own line {k}" for k in range(60))])
    assert sum(r["n_dropped"] for r in got) == 60


# --- empty tables, clashing columns, repeated rows ------------------------------------


def odd_documents(spark, rows, *more):
    """documents(id, text) beside columns that bear the names of results."""
    extra = [f"'other' AS `{c}`" for c in ("lang_pred", "score", "n_lines", "n_dropped", "gone", "row", "h", "n_tokens", "n_bytes", *more)]
    return spark.createDataFrame(rows, "id long, text string").selectExpr(*extra, "text", "id")


def test_empty_tables(spark, model):
    empty = odd_documents(spark, [])
    assert langid.identified(empty, model).collect() == [] and langid.recognised(empty, model).collect() == []
    assert tokens.counted(empty).collect() == []
    assert line_dedup.without_repeated_lines(empty).collect() == []
    assert html_text.extracted(spark.createDataFrame([], "id long, url string, html string")).collect() == []


def test_columns_of_clashing_names_do_not_matter(spark, model):
    shared = "a line that two documents hold"
    rows = [*ODD, (7, f"own\n{shared}"), (8, f"{shared}\nx"), (8, f"{shared}\nx")]
    plain, odd = spark.createDataFrame(rows, "id long, text string"), odd_documents(spark, rows)
    for f in (lambda d: langid.identified(d, model), tokens.counted, line_dedup.without_repeated_lines):
        want, got = f(plain), f(odd)
        assert got.columns == want.columns
        assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
        assert got.count() == len(rows)
    pages = [(1, "u", "<article><p>Some words of the article, more than a few of them.</p></article>"), (1, "u", None), (None, None, "")]
    page = spark.createDataFrame(pages, "id long, url string, html string")
    clashing = page.selectExpr("'other' AS text", "'other' AS page", "html", "url", "id")
    assert sorted(html_text.extracted(clashing).collect(), key=repr) == sorted(html_text.extracted(page).collect(), key=repr)


def test_repeated_rows_get_equal_results(spark, model):
    rows = [(5, "x" * 50_000), (5, "x" * 50_000), (6, "the thing and"), (6, "the thing and")]
    docs = spark.createDataFrame(rows, "id long, text string")
    for f in (lambda d: langid.identified(d, model), tokens.counted):
        got = f(docs).collect()
        assert len(got) == 4 and len(set(got)) == 2
