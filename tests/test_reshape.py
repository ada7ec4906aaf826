import pytest

from conftest import records
from slotweave.errors import DataError
from slotweave.operators import curies
from slotweave.operators.replace import replace_cells
from slotweave.operators.reshape import (
    header_names, join_distinct_text, latest_version, pivot_mean, pivot_unique, require_unique, union_distinct,
)


def test_join_distinct_text(frame):
    df = frame([("1", "b", None), ("1", "a", None), ("1", "b", "x"), (None, "c", None)], ("k", "p", "q"))
    rows = records(join_distinct_text(df, ["k"], ["p", "q"]), "k")
    assert [(r["k"], r["p"], r["q"]) for r in rows] == [("1", "a, b", "x"), (None, "c", "")]


def test_pivot_unique(spark):
    df = spark.createDataFrame([(1, 1, 40), (1, 3, 42), (2, 1, 50), (3, None, 9)], "id int, timepoint int, age int")
    out = pivot_unique(df, "id", "timepoint", "age", "age_at_timepoint_{}")
    assert out.columns == ["id", "age_at_timepoint_1", "age_at_timepoint_3"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 40, 42), (2, 50, None), (3, None, None)]
    twice = df.unionAll(spark.createDataFrame([(2, 1, 51)], df.schema))
    with pytest.raises(Exception, match="duplicate timepoint for id 2"):
        pivot_unique(twice, "id", "timepoint", "age").collect()


def test_pivot_mean(spark):
    df = spark.createDataFrame(
        [(1, 1, 2.0, None), (1, 1, 4.0, None), (1, 3, None, 7.0), (2, 1, None, None)], "id int, timepoint int, h double, w double"
    )
    out = pivot_mean(df, "id", "timepoint")
    assert out.columns == ["id", "h_timepoint_1", "h_timepoint_3", "w_timepoint_1", "w_timepoint_3"]
    assert [tuple(r) for r in out.collect()] == [(1, 3.0, None, None, 7.0)]


@pytest.mark.parametrize("pivot", [lambda df: pivot_mean(df, "id", "t", values=[1]), lambda df: pivot_unique(df, "id", "t", "v", values=[1])])
def test_unlisted_pivot_values_are_not_lost(spark, pivot):
    df = spark.createDataFrame([(1, 1, 2.0), (2, 2, 3.0)], "id int, t int, v double")
    assert pivot(df.filter("t = 1")).count() == 1
    with pytest.raises(Exception, match="not among the listed"):
        pivot(df).collect()


def test_many_pivot_values(spark):
    assert len(pivot_mean(spark.range(1100).selectExpr("id", "id t", "1.0 v"), "id", "t").columns) == 1101


def test_unique_guard(frame):
    df = frame([("a", "x"), ("a", "y")], ("k", "v"))
    require_unique(df, ["k", "v"], "frame")
    with pytest.raises(DataError, match="frame has duplicate"):
        require_unique(df, ["k"], "frame")


def test_union_distinct(frame):
    out = union_distinct([frame([("1", "2")], ("a", "b")), frame([("1",), ("1",)], ("a",)), frame([("2", "1")], ("b", "a"))])
    assert {tuple(r) for r in out.collect()} == {("1", "2"), ("1", None)}


def test_header_names(spark):
    out = header_names(["id", "t", "VSD", "asd", "vsd", "Asthma"], spark, start=3)
    assert [r.conditions for r in out.collect()] == ["Asthma", "asd", "vsd"]


def test_versions(frame):
    df = frame([("g", "specs-v1.9.2"), ("g", "specs-v1.10.0"), ("h", "v2")], ("g", "version"))
    assert {tuple(r) for r in latest_version(df, "version", ["g"]).collect()} == {("g", "specs-v1.10.0"), ("h", "v2")}


def rules_frame(frame, rules):
    return frame(rules, ("filename", "column_name", "original_value", "replacement_value"))


def test_replacements(frame):
    df = frame([("a", "b"), ("b", None), ("c", "a")], ("x", "y"))
    rules = rules_frame(frame, [("f.csv", "x", "a", "b"), ("f.csv", "x", "b", "first"), ("f.csv", "x", "b", "last"),
                                ("f.csv", "y", None, "blank"), ("g.csv", "x", "c", "no"), ("f.csv", "absent", "a", "b")]).coalesce(1)
    assert [tuple(r) for r in replace_cells(df, rules, "f.csv").collect()] == [("b", "b"), ("last", "blank"), ("c", "a")]
    assert replace_cells(df, rules, "other.csv").collect() == df.collect()


def test_many_replacements(spark, frame):
    df = frame([(str(i % 90), str(i)) for i in range(300)], ("x", "y"))
    rules = rules_frame(frame, [("f", c, str(i), f"{c}{i}") for c in "xy" for i in range(0, 80, 2)])
    new = lambda c, v: f"{c}{v}" if int(v) < 80 and int(v) % 2 == 0 else v
    want = sorted((new("x", str(i % 90)), new("y", str(i))) for i in range(300))
    assert sorted(map(tuple, replace_cells(df, rules, "f").collect())) == want


TEXTS = [("f1", "see OMOP:1, OMOP:12 and xOMOP:1 or MONDO:0004;"), ("f1", None), ("f2", "nothing here a:b"), ("f2", "OMOP:1"), ("f3", "OMOP:1"),
         ("f3", "a\x01\x02OMOP:1\x01")]


def test_curies(frame):
    df = frame(TEXTS, ("file", "text"))
    assert {tuple(r) for r in curies.curie_inventory(df, "text").collect()} == {("OMOP:1", 4), ("OMOP:12", 1), ("MONDO:0004", 1)}
    assert {tuple(r) for r in curies.curie_audit(df, "text", "file").collect()} == {("f1", 1, 3), ("f2", 1, 1), ("f3", 2, 2)}
    mapping = frame([("OMOP:1", "NEW:9"), ("MONDO:0004", "OMOP:1"), (None, "x")], ("old", "new"))
    want = [("f1", "see NEW:9, OMOP:12 and xOMOP:1 or OMOP:1;"), ("f1", None), ("f2", "nothing here a:b"), ("f2", "NEW:9"), ("f3", "NEW:9"), ("f3", "a\x01\x02NEW:9\x01")]
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(curies.remap_curies(df, "text", mapping)) == sorted(want, key=str)
    assert rows(curies.remap_curies(df, "text", mapping.limit(0))) == rows(df)
