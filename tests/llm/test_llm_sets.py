"""Archives, shards, top-k, decontamination, near-duplicates, mixing and the pipeline, against brute force and on odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from slotweave.llm import decontaminate, mixing, near_dup, sharding, topk, warc
from slotweave.llm.common import components, flagged, new_path

SF = "/root/testdata/sf0.001"


def prose(r, n):
    return " ".join("".join(r.choices(["ba", "lo", "ti", "en", "ur", "sha"], k=r.randint(1, 4))) for _ in range(n))


def leaks(texts, index):
    return decontaminate.leaks(pa.array(texts, pa.string()), index)


# --- archives -----------------------------------------------------------------


def test_joined_is_normal():
    """Code points in a row are the normal forms, for every code point and for odd texts."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [None, "", " ", "\0", "a\0B", " -A- ", "".join(every), "x".join(every), *every[:2000], None]
    c, ends = decontaminate.joined(pa.array(texts, pa.string()), decontaminate.letters())
    starts = [0, *(ends[:-1] + 1)]
    got = [c[s:e].tobytes().decode("utf-32-le") for s, e in zip(starts, ends)]
    assert got == decontaminate.normals(pa.array(texts, pa.string())).to_pylist()
    c, ends = decontaminate.joined(pa.array([], pa.string()), decontaminate.letters())
    assert len(ends) <= 1


def test_archives_round_trip(spark):
    r = random.Random(1)
    same = f"<p>{prose(r, 50)}</p>"
    rows = [(i, f"http://x/{i}", f"<p>{prose(r, 40)}</p>") for i in range(30)]
    rows += [(40, None, same), (41, "http://x/é\r\nEvil: 1", same), (42, "u", same), (42, "u", same), (50, "u", None), (51, "u", ""), (None, "u", same)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS sha")
    folder = new_path(spark, "warc-test")
    assert sum(x["records"] for x in warc.write_archives(df, folder).collect()) == len(rows)
    got = warc.read_archives(spark, folder).collect()
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, h in rows:
        first = i == last[h or ""]
        raw = (h or "").encode()
        want[(i, len(raw), warc.payload_digest(raw), "response" if first else "revisit", None if first else last[h or ""])] += 1
    assert Counter((x["page_id"], x["payload_bytes"], x["payload_digest"], x["record_type"], x["refers_to"]) for x in got) == want
    assert all(len(x["payload"]) == (0 if x["record_type"] == "revisit" else x["payload_bytes"]) for x in got)


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.fixture(scope="module")
def archive():
    import zstandard

    texts = [f"page {k} of the archive, with words".encode() * 9 for k in range(60)]
    raw = [warc.record_bytes(k, "u", t, warc.payload_digest(t), None, False) for k, t in enumerate(texts)]
    words = warc.trained_dictionary(raw)
    c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words), write_checksum=True)
    return warc.dictionary_frame(words), [c.compress(x) for x in raw], texts


def test_reader_loads_the_dictionary(archive):
    import zstandard

    head, frames, texts = archive
    assert len(head) > 8
    assert [warc.page_of(x)[6] for x in warc.records(head + b"".join(frames))] == texts
    packed = warc.dictionary_frame(zstandard.ZstdCompressor().compress(head[8:]))
    assert len(list(warc.records(packed + frames[0]))) == 1
    assert len(list(warc.records(head + frames[0] + b"\x50\x2a\x4d\x18\x02\0\0\0xx" + frames[1]))) == 2
    assert list(warc.records(b"")) == []


@pytest.mark.parametrize("harm", ["cut", "flip", "nodict", "junk", "two"])
def test_reader_refuses_damage(archive, harm):
    import zstandard

    head, frames, _ = archive
    data = {
        "cut": head + frames[0][:-5],
        "flip": head + frames[0][:40] + bytes([frames[0][40] ^ 255]) + frames[0][41:],
        "nodict": frames[0],
        "junk": head + frames[0] + b"junk",
        "two": zstandard.ZstdCompressor().compress(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcd\r\n\r\n"),
    }[harm]
    with pytest.raises(warc.WarcError):
        list(warc.records(data))


# --- shards -----------------------------------------------------------------------


def test_shards(spark):
    r = random.Random(2)
    rows = [(i, prose(r, r.randint(1, 200))) for i in range(400)] + [(None, "a"), (None, None), (7, "twice"), (7, "twice"), (8, "é")]
    df = spark.createDataFrame(rows, "id long, text string").selectExpr("*", "0 AS shard", "0 AS size")
    got = sharding.sharded(df.select("id", "text"), 8, slots=512).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((x["id"], x["size"], x["text_crc32"]) for x in got) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    load, places = Counter(), defaultdict(list)
    for x in got:
        load[x["shard"]] += x["size"]
        places[x["shard"]].append(x["slot"])
    assert max(load.values()) - min(load.values()) <= max(size(t) for _, t in rows)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert sharding.sharded(df.select("id", "text").limit(0), 8, slots=16).count() == 0


def test_map_is_versioned_and_edited(spark):
    r = random.Random(3)
    sizes = {s: (r.randint(1, 1000), 1) for s in range(256)}
    first = sharding.balanced(sizes, 8, 256)
    path = new_path(spark, "map-test")
    sharding.write_map(spark, path, 1, first, sizes)
    grown = {s: (n * (5 if first[s] == 0 else 1), 1) for s, (n, _) in sizes.items()}
    second = sharding.rebalanced(first, grown, 8)
    nine = sharding.rebalanced(first, sizes, 9)
    sharding.write_map(spark, path, 2, second, grown)
    assert sharding.map_versions(spark, path) == [1, 2]
    assert sharding.as_dict(sharding.read_map(spark, path, 1).collect()) == first
    load = Counter()
    for s, k in second.items():
        load[k] += grown[s][0]
    assert max(load.values()) < 1.1 * sum(load.values()) / 8
    assert sum(first[s] != second[s] for s in first) < 64
    moved = [nine[s] for s in first if nine[s] != first[s]]
    assert len(moved) < 48 and moved.count(8) > 0.9 * len(moved)
    assert set(sharding.rebalanced(first, sizes, 7).values()) == set(range(7))


def test_rows_are_placed_by_an_edited_map(spark):
    r = random.Random(4)
    rows = [(i, prose(r, r.randint(1, 100))) for i in range(600)] + [(None, "a"), (7, "twice"), (7, "twice")]
    df = spark.createDataFrame(rows, "id long, text string")
    path = new_path(spark, "map-test")
    runs = []
    for version, (docs, shards) in enumerate([(df.where("id < 400"), 8), (df, 8), (df, 9), (df, 5)], 1):
        got = sharding.sharded(docs, shards, slots=256, path=path).collect()
        assert len(got) == docs.count() and {x["map_version"] for x in got} == {version}
        stored = sharding.as_dict(sharding.read_map(spark, path, version).collect())
        assert all(stored[x["virtual_slot"]] == x["shard"] for x in got) and {x["shard"] for x in got} == set(range(shards))
        places = defaultdict(list)
        for x in got:
            places[x["shard"]].append(x["slot"])
        assert all(sorted(p) == list(range(len(p))) for p in places.values())
        runs.append(stored)
    assert sharding.map_versions(spark, path) == [1, 2, 3, 4]
    assert sum(runs[0][s] != runs[1][s] for s in range(256)) < 64 and sum(runs[1][s] != runs[2][s] for s in range(256)) < 64
    with pytest.raises(ValueError, match="virtual slots"):
        sharding.sharded(df, 8, slots=128, path=path)


# --- top-k --------------------------------------------------------------------------


def test_top_k_against_brute_force(spark):
    r = np.random.default_rng(4)
    rows = [(i, r.normal(0, 0.2, 12).tolist()) for i in range(300)] + [(i, [0.25] * 12) for i in range(300, 330)]
    rows += [(500, None), (501, []), (502, [float("nan")] * 12), (503, [None] * 12), (600, [1.0, 2.0]), (None, [1.0] * 12), (700, [1e3] * 3)]
    rows += [(800, [0.5] * 5), (801, [0.0] * 5)]
    df = spark.createDataFrame(rows, "id long, vector array<double>").selectExpr("*", "1 AS score")
    got = defaultdict(list)
    from pyspark.sql import functions as F

    for x in sorted(topk.top_k(df, F.col("id") % 100 == 0).collect(), key=lambda x: x["rank"]):
        got[x["query_id"]].append((x["rank"], x["vec_id"], x["score"]))
    good = {i: np.floor(np.array(v) * 1024).astype(int) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    for q in (i for i in good if i % 100 == 0):
        want = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:10]
        assert got.get(q, []) == [(n, i, -s) for n, (s, i) in enumerate(want, 1)]


@pytest.mark.parametrize("bits", [1, 3, 8, 16])
def test_slices_select_the_best(bits):
    r = np.random.default_rng(bits)
    rows = r.integers(-600, 600, (333, 7))
    block = topk.SlicedBlock(np.arange(333), rows, bits)
    for q in r.integers(-700, 700, (5, 7)):
        want = sorted((-int(s), i) for i, s in enumerate(rows @ q) if i != 5)[:10]
        assert block.best(5, q, 10) == [(i, -s) for s, i in want]


# --- decontamination ---------------------------------------------------------------------


def test_leaks_within_the_budget(spark):
    r = random.Random(6)
    items = [(k, prose(r, 40)) for k in range(8)] + [(90, None), (91, " ! "), (92, "tiny one"), (93, prose(r, 400))]
    text = dict(items)
    swap = lambda s, n: "".join("z" if i in places else c for i, c in enumerate(s)) if (places := set(r.sample(range(len(s)), n))) is not None else s
    edits = decontaminate.edit_budget(len(text[2]))
    docs = [
        (1, prose(r, 300) + ". " + text[0].upper().replace(" ", ",\n ") + "! " + prose(r, 50)),
        (2, text[1]),
        (3, prose(r, 30) + " " + swap(text[2], edits // 2) + " " + prose(r, 30)),
        (4, text[3][: len(text[3]) // 2] + " " + prose(r, 100)),
        (5, prose(r, 3000)),
        (6, None),
        (7, ""),
        (8, "so tiny, one of them; Tiny One"),
        (9, "tinyone"),
        (10, text[93]),
        (None, text[4]),
    ]
    df = spark.createDataFrame(docs, "id long, text string")
    bench = spark.createDataFrame(items, "id long, text string")
    got = {(x["id"], x["item_id"]): x for x in decontaminate.contaminated(df, bench).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, 2), (8, 92), (10, 93), (None, 4)}
    assert got[(1, 0)]["edits"] == 0 and 0 < got[(3, 2)]["edits"] <= edits
    span = dict(docs)[1][got[(1, 0)]["start"] : got[(1, 0)]["end"]]
    assert decontaminate.normal(span) == decontaminate.normal(text[0])
    clean = decontaminate.clean(df.selectExpr("*", "7 AS item_id"), bench)
    assert sorted(x["id"] for x in clean.collect()) == [4, 5, 6, 7, 9] and clean.columns == ["id", "text", "item_id"]
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


def edit_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("window", [decontaminate.WINDOW, 16])
def test_leaks_miss_nothing_within_the_budget(monkeypatch, window):
    monkeypatch.setattr(decontaminate, "WINDOW", window)
    r = random.Random(7)
    for _ in range(60):
        item = prose(r, 30)
        index = decontaminate.indexed([(1, item)])
        c = list(item)
        for _ in range(r.randint(0, int(index.budget[0]) + 4)):
            k = r.randrange(len(c))
            c[k : k + 1] = r.choice([[], ["q"], [c[k], "q"]])
        text = decontaminate.normal(f"{prose(r, 20)} {''.join(c)} {prose(r, 20)}")
        least = edit_distance(decontaminate.normal(item), text)
        found = leaks(["", text, "other"], index)
        assert [(x[0], x[4]) for x in found] == ([(1, least)] if least <= index.budget[0] else [])


def edited(r, item, n, words):
    w = item.split()
    for k in r.sample(range(len(w)), n):
        w[k] = r.choice(words)
    return " ".join(w)


def test_edited_and_partial_copies_are_found_and_clean_texts_are_not(spark):
    r = random.Random(8)
    items = [decontaminate.normal(x["text"]) for x in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    index, words = decontaminate.indexed(list(enumerate(items))), " ".join(items).split()
    for least, n in ((1.0, lambda w: 1), (0.95, lambda w: 2), (0.95, lambda w: -(-w // 10))):
        copies = [(k, edited(r, t, n(len(t.split())), words)) for k, t in enumerate(items) for _ in range(5)]
        found = {(x[0], x[1]) for x in leaks([f"{prose(r, 20)} {c} {prose(r, 20)}" for _, c in copies], index)}
        assert sum((row, k) in found for row, (k, _) in enumerate(copies)) >= least * len(copies)
    assert leaks([" ".join(r.choices(words, k=300)) for _ in range(50)], index) == []


def test_long_items_are_found_by_their_passages():
    r = random.Random(9)
    item = decontaminate.normal(prose(r, 300))
    index = decontaminate.indexed([(5, item)])
    for at in range(0, len(item) - 300, 70):
        quote = item[at : at + 300]
        ((_, i, start, end, edits),) = leaks([f"{prose(r, 50)} {quote} {prose(r, 50)}"], index)
        assert i == 0 and end - start >= 200 and edits <= decontaminate.edit_budget(decontaminate.PASSAGE)
    assert [x[1:] for x in leaks([item], index)] == [(0, 0, len(item), 0)]
    assert leaks([item[:120] + " " + prose(r, 100)], index) == []


def test_many_items_are_counted_as_few(monkeypatch):
    r = random.Random(10)
    items = [(k, prose(r, 40)) for k in range(60)]
    text = decontaminate.normal(" ".join([prose(r, 200), items[3][1], prose(r, 200), items[50][1]]))
    index = decontaminate.indexed(items)
    want = leaks([text, ""], index)
    monkeypatch.setattr(decontaminate, "DENSE", 0)
    assert leaks([text, ""], index) == want and {x[1] for x in want} == {3, 50}


def test_slices_are_bounded(monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE_CHARS", 10)
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n if n is not None else None for n in (4, 4, 30, None, 0, 9, 2)]})
    sizes = [[len(t or "") for t in p.column("text").to_pylist()] for p in decontaminate._slices([batch])]
    assert sizes == [[4, 4], [30], [0, 0, 9], [2]]
    assert list(decontaminate._slices([batch.slice(0, 0)])) == []


# --- near-duplicates -------------------------------------------------------------------------


def brute_components(rows, percent):
    def grams(t):
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [(i, grams(t)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                up[y] = x
    return sorted((str(i), len(s), str(None if i is None else find(i)), i is None or find(i) == i) for i, s in sets)


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_against_brute_force(spark, percent):
    r = random.Random(percent)
    rows, k = [], 0
    for _ in range(12):
        base = prose(r, 120).split()
        for edits in r.choices(range(0, 6), k=r.choice([1, 2, 6])):
            w = list(base)
            for _ in range(edits):
                w[r.randrange(len(w))] = "edited"
            rows.append((k, " ".join(w).upper() if edits % 2 else " \n".join(w)))
            k += 1
    rows += [(100, None), (101, ""), (102, " \t"), (103, "one two"), (104, "ONE  two"), (105, "two one"), (None, rows[0][1]), (106, rows[0][1]), (106, "other words here")]
    rows += [(200 + i, rows[0][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS component_id")
    got = near_dup.near_duplicates(df, percent).collect()
    assert sorted((str(x[0]), x[1], str(x[2]), x[3]) for x in got) == brute_components(rows, percent)


def test_mixed_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    r = random.Random(11)
    base = prose(r, 150).split()
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.randint(2, 7)):
            w[r.randrange(len(w))] = r.choice("xyz")
        rows.append((i, " ".join(w)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(x[0]), x[1], str(x[2]), x[3]) for x in got) == brute_components(rows, 85)


def test_posterior_bounds():
    for n, least in near_dup.bounds(0.85):
        assert near_dup.posterior(least, n, 0.85) >= near_dup.MISS
        assert least == 0 or near_dup.posterior(least - 1, n, 0.85) < near_dup.MISS


def test_no_documents(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = dict(components(links).collect())
    assert {got[i] for i in range(301)} == {0} and got[1001] == 1000


def test_filter_has_no_false_negatives(spark):
    ids = spark.createDataFrame([(i * 7919,) for i in range(500)], "id long")
    rows = spark.createDataFrame([(i * 7919,) for i in range(2000)] + [(None,)], "id long")
    got = {x["id"]: x["maybe"] for x in flagged(rows, ids).collect()}
    assert all(got[i * 7919] for i in range(500)) and sum(got.values()) < 510 and got[None] is False


def test_top_k_of_large_components(spark):
    r = random.Random(8)
    vectors = [(k, [float(r.randint(-9, 9)) for _ in range(6)]) for k in range(120)]
    vectors += [(200, [1e8, -3.0, 0.5, 2.0, 1.0, 7.0]), (201, [16_384.0] * 6), (300, [-1e11, 1e11, 0.0, 1.0, 2.0, 3.0])]
    got = topk.top_k(spark.createDataFrame(vectors, "id long, vector array<double>"), F.col("id") % 100 == 0, k=4).collect()
    q = {i: [int(x * 1024 // 1) for x in v] for i, v in vectors}
    for query in (0, 100, 200, 300):
        want = sorted(((-sum(a * b for a, b in zip(q[query], q[i])), i) for i in q if i != query))[:4]
        fits = [(i, -s) for s, i in want]
        assert [(x["vec_id"], x["score"]) for x in sorted((g for g in got if g["query_id"] == query), key=lambda g: g["rank"])] == fits


# --- mixing --------------------------------------------------------------------------------------


def test_mix(spark):
    r = random.Random(12)
    rows = [(i, r.choice(["b", "a", "é", None]), prose(r, r.randint(1, 60))) for i in range(600)]
    rows += [(601, "a", None), (602, "only empty", ""), (603, "b", "x " * 3000), (None, "a", "w w"), (604, "b", "t t"), (604, "b", "t t")]
    df = spark.createDataFrame(rows, "id long, source string, text string").selectExpr("*", "1 AS target_words")
    got = mixing.mixed(df).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = Counter()
    for _, s, t in rows:
        total[s] += size(t)
    target = mixing.source_targets(dict(total))
    assert sum(target.values()) == pytest.approx(1.5 * sum(total.values()))
    taken = Counter()
    for x in got:
        assert x["size"] == size(x["text"]) and x["copies"] in (0, 1, 2) and x["source_size"] == total[x["source"]]
        taken[x["source"]] += x["copies"] * x["size"]
    for s in total:
        assert abs(taken[s] - target[s]) <= max(size(t) for _, q, t in rows if q == s)
    again = mixing.mixed(df.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mixed(df.limit(0)).count() == 0


@pytest.mark.parametrize("equal", [500, 3])
def test_equal_rows_that_meet_the_cut_are_taken_in_part(spark, equal):
    """Three sources of 5000 words each, one of them equal rows that share their place in the order."""
    rows = [(k, "b", "w " * 10) for k in range(500)] + [(1000 + k, "c", "w " * 10) for k in range(500)]
    rows += [(-1, "a", "w " * (5000 // equal)) for _ in range(equal)] + [(-2, "a", "w " * (5000 % equal))]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "id long, source string, text string, number int").repartition(5)
    got = mixing.mixed(df, weights=(1, 1, 1), share=1.25).collect()
    assert len(got) == len(rows) and {x["copies"] for x in got} <= {0, 1, 2}
    taken = Counter()
    for x in got:
        taken[x["source"]] += x["copies"] * x["size"]
    for s in "abc":
        most = max(x["size"] for x in got if x["source"] == s)
        assert abs(taken[s] - 6250) <= most / 2 + 1e-6
    assert Counter((x["id"], x["number"]) for x in got) == Counter((r[0], k) for k, r in enumerate(rows))


def test_targets_by_hand():
    assert mixing.source_targets({"a": 100, "b": 100, None: 100}) == pytest.approx({"a": 200.0, "b": 250 / 3, None: 500 / 3})
    assert mixing.source_targets({"a": 10, "b": 1000}) == pytest.approx({"a": 20.0, "b": 1495.0})
    assert mixing.source_targets({"a": 0}) == {"a": 0.0}


def test_inclusion_follows_the_odds(spark):
    rows = [(i, "s", " ".join(["w"] * (1 if i % 2 else 200))) for i in range(4000)] + [(9000 + i, "t", "w " * 300) for i in range(1000)]
    got = mixing.mixed(spark.createDataFrame(rows, "id long, source string, text string"), weights=(1, 2)).collect()
    sizes = Counter(x["size"] for x in got if x["source"] == "s")
    copies = Counter()
    for x in got:
        if x["source"] == "s":
            copies[x["size"]] += x["copies"]
    rate = mixing.class_copies({1: sizes[1] * 1, 8: sizes[200] * 200}, got[0]["target"] if got[0]["source"] == "s" else 0)
    assert copies[1] / sizes[1] == pytest.approx(rate[1], abs=0.05)
    assert copies[200] / sizes[200] == pytest.approx(rate[8], abs=0.05)


# --- the pipeline ------------------------------------------------------------------------------------


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    step, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = corpus_pipeline.stored(stage(spark, step, SF), name)
        assert step.columns == list(corpus_pipeline.COLUMNS)
        kept[name] = [r["doc_id"] for r in step.collect()]
    assert sorted(kept["language_id"]) == sorted(text)
    groups = brute_components(sorted(text.items()), 80)
    assert sorted(kept["near_duplicates"]) == sorted(int(i) for i, _, _, first in groups if first)
    items = [decontaminate.normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {i for i in kept["near_duplicates"] if any(x in decontaminate.normal(text[i]) for x in items)}
    assert sorted(kept["decontamination"]) == sorted(set(kept["near_duplicates"]) - dirty)
    got = corpus_pipeline.STAGES[-1][1](spark, step, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(kept["mixing"])
    assert len({(r["shard"], r["slot"]) for r in got}) == len(got)


def test_stages_take_odd_rows(spark):
    rows = [(1, None, "en", "a", 0), (None, "the words of it", None, None, None), (2, "", "de", None, 0), (2, "twice the id", None, "a", 3), (3, "123", None, "a", 3)]
    step = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS size", "2 AS copies")
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, SF)
        step.collect()
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0


def test_pipeline_tells_rows_of_one_id_apart(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(31)
    a, b, c = (prose(r, 80) for _ in range(3))
    rows = [(1, a), (1, b), (None, c), (None, c), (2, c), (None, prose(r, 80)), (3, "x"), (3, "x"), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [x["text"] for x in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [a, b, c, rows[5][1], "x", None]))


def test_empty_and_clashing_tables(spark):
    item = spark.createDataFrame([(1, "a benchmark item of quite some words that nobody else would write down")], "id long, text string")
    none = item.limit(0)
    assert decontaminate.contaminated(none, item).collect() == [] and decontaminate.contaminated(item, none).collect() == []
    assert decontaminate.clean(none, item).collect() == [] and decontaminate.clean(item, none).count() == 1
    vectors = spark.createDataFrame([], "id long, vector array<double>")
    assert topk.top_k(vectors, F.col("id") % 100 == 0).collect() == []
    rows = [(1, f"before {item.first()['text']} after"), (1, f"before {item.first()['text']} after"), (2, "clean"), (None, None)]
    docs = spark.createDataFrame(rows, "id long, text string")
    clashing = docs.selectExpr("'x' AS item_id", "'x' AS edits", "'x' AS start", "'x' AS maybe", "text", "id")
    assert sorted(decontaminate.contaminated(clashing, item).collect(), key=repr) == sorted(decontaminate.contaminated(docs, item).collect(), key=repr)
    left = decontaminate.clean(clashing, item)
    assert left.columns == clashing.columns and sorted(r["id"] or 0 for r in left.collect()) == [0, 2]


def test_few_qgrams_are_counted_and_every_match_shares_enough_of_them():
    r = random.Random(11)
    items = [(i, decontaminate.normal(prose(r, r.randint(4, 70)))) for i in range(60)]
    index = decontaminate.indexed(items)
    # Every q-gram was a posting: about one a character, where a third and the short items' do.
    assert len(index.item) < sum(len(t) for t in index.texts) / 2
    for text, most in zip(index.texts, index.budget):
        places, bound = decontaminate.counted(len(text), int(most))
        assert bound >= min(decontaminate.PIECES, len(text) + 1 - decontaminate.Q) or len(text) < 2 * decontaminate.SHORT
        for _ in range(5):
            c = list(text)
            for at in r.sample(range(len(c)), int(most)):
                c[at] = r.choice(["", "q", c[at] + "z"])
            changed = "".join(c)
            assert sum(text[p : p + decontaminate.Q] in changed for p in places) >= bound
