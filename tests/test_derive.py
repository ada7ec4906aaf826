import uuid

import pytest
from pyspark.sql import functions as F

from conftest import records
from slotweave import Catalog, DataError, Mapper, SourceError, SpecError, parse_schema, parse_specs
from slotweave.streaming import stream_records


def mapper(spark, tables, spec, schema=None, **kw):
    return Mapper(Catalog.of(spark, tables), parse_specs([spec]), parse_schema(schema) if schema else None, **kw)


def slots(**exprs):
    lines = ["class_derivations:", "  C:", "    populated_from: t", "    slot_derivations:"]
    for name, body in exprs.items():
        lines.append(f"      {name}: {body}")
    return "\n".join(lines)


def value_of(spark, frame, expr, **cells):
    """The one-slot result of an expression over one row."""
    df = frame([tuple(cells.values())], tuple(cells)) if cells else frame([("x",)], ("unused",))
    text = expr.replace("'", "''")
    return mapper(spark, {"t": df}, slots(v=f"{{expr: '{text}'}}"), strict=True).derive("C").records.first().v


@pytest.mark.parametrize(
    ("expr", "cells", "want"),
    [
        ("{a} * 365", {"a": "40"}, 14600.0),
        ("-{a} + 2 * ({b} - 1) / 4", {"a": "1", "b": "3"}, 0.0),
        ("a * 2", {"a": "1.5"}, 3.0),
        ("{a} * 2", {"a": None}, None),
        ("{a} * 2", {"a": ""}, None),
        ("{a} + ' ' + {b}", {"a": "x", "b": "y"}, "x y"),
        ("str({a}) + ':CHS'", {"a": "7"}, "7:CHS"),
        ("str({a} * 2)", {"a": "7"}, "14"),
        ("str({a} / 4)", {"a": "7"}, "1.75"),
        ("case(({a} == 1, 'A'), ({a} == 2, 'B'))", {"a": "2"}, "B"),
        ("case(({a} == 1, 'A'), ({a} == 2, 'B'))", {"a": "3"}, None),
        ("case(({a} == 1, 'A'), ({a} == 2, 'B'))", {"a": "1.0"}, "A"),
        ("'p' if {a} == 1 else 'q' if {b} == 1 else 'r'", {"a": "0", "b": "1"}, "q"),
        ("'p' if {a} == 1 else 'q' if {b} == 1 else 'r'", {"a": "x", "b": None}, "r"),
        ("'y' if {a} == 'x' and not {b} != 'z' else 'n'", {"a": "x", "b": "z"}, "y"),
        ("'y' if 1 < {a} <= 3 or False else 'n'", {"a": "3"}, "y"),
        ("{a} / 2 if {a} > 1 else 0", {"a": "3"}, 1.5),
        ("10 / {a} if {a} != 0 else 0", {"a": "0"}, 0.0),
        ("'x'", {}, "x"),
        ("uuid5('https://w3id.org/bdchm/Visit', str({a}) + ':V')", {"a": "9"},
         str(uuid.uuid5(uuid.uuid5(uuid.NAMESPACE_URL, "https://w3id.org/bdchm/Visit"), "9:V"))),
        ("uuid5('6ba7b810-9dad-11d1-80b4-00c04fd430c8', {a})", {"a": "é"}, str(uuid.uuid5(uuid.NAMESPACE_DNS, "é"))),
    ],
)
def test_expressions(spark, frame, expr, cells, want):
    assert value_of(spark, frame, expr, **cells) == want


@pytest.mark.parametrize(
    "expr",
    ["__import__('os').getcwd()", "open('x')", "[1]", "lambda: 1", "{a}.upper()", "{a, a}", "{a} ** 2", "{nope} * 1",
     "{a} * ", "case({a} == 1)", "uuid5({a}, 'x')", "str()", "{a} in 'x'"],
)
def test_refused_expressions(spark, frame, expr):
    with pytest.raises(SpecError):
        value_of(spark, frame, expr, a="1")


@pytest.mark.parametrize(("expr", "message"), [("{a} / 0", "division by zero"), ("{b} * 2", "non-numeric value")])
def test_strict_and_lenient_errors(spark, frame, expr, message):
    df = frame([("1", "A", "k1"), (None, None, "k2")], ("a", "b", "k"))
    spec = slots(k="{populated_from: k}", v=f"{{expr: '{expr}'}}")
    lenient = mapper(spark, {"t": df}, spec).derive("C")
    assert [r.k for r in lenient.records.collect()] == ["k2"]
    assert [tuple(r) for r in lenient.errors.collect()] == [("C", "t", "v", message, 1)]
    with pytest.raises(DataError, match=message):
        lenient.require_clean()
    with pytest.raises(Exception, match=message):
        mapper(spark, {"t": df}, spec, strict=True).derive("C").records.collect()


def test_strict_and_lenient_agree_on_clean_data(spark, frame):
    df = frame([("1", "2"), ("3", None)], ("a", "b"))
    spec = slots(x="{expr: '{a} / {b}'}", y="{expr: '{a} + 1'}")
    assert records(mapper(spark, {"t": df}, spec).derive("C").records) == records(
        mapper(spark, {"t": df}, spec, strict=True).derive("C").records
    )


def test_refused_block_is_reported_and_skipped(spark, frame):
    df = frame([("1",)], ("a",))
    bad = slots(a="{expr: '__import__(\"os\").getcwd()'}")
    good = slots(a="{populated_from: a}")
    m = Mapper(Catalog.of(spark, {"t": df}), parse_specs([bad, good, good.replace("from: t", "from: absent")]))
    d = m.derive("C")
    assert [r.a for r in d.records.collect()] == ["1"]
    errors = records(d.errors, "table")
    assert [(e["table"], e["n"]) for e in errors] == [("absent", None), ("t", None)]
    assert "Import expressions are not supported" in errors[1]["message"]
    only_bad = Mapper(Catalog.of(spark, {"t": df}), parse_specs([bad])).derive("C")
    assert only_bad.records.count() == 0 and only_bad.errors.count() == 1


def test_mappings_and_text_keys(spark, frame):
    df = spark.createDataFrame([(1.0, "1", 1), (2.5, "None", 7)], "d double, s string, i int")
    spec = slots(
        d="{populated_from: d, value_mappings: {'1': one, '2.5': half}}",
        s="{populated_from: s, value_mappings: {1: None, 'None': nothing}}",
        i="{populated_from: i, value_mappings: {'1': one}}",
    )
    got = [tuple(r) for r in mapper(spark, {"t": df}, spec).derive("C").records.collect()]
    assert got == [("one", "None", "one"), ("half", "nothing", None)]


def test_coercion_to_declared_types(spark, frame):
    df = frame([("40.0", "2024-01-31", "x", "7"), ("A", "no", None, None)], ("i", "d", "s", "q_decimal"))
    schema = "classes: {C: {attributes: {i: {range: integer}, d: {range: date}, s: , q_decimal: , extra: }}}"
    spec = slots(i="{populated_from: i}", d="{populated_from: d}", s="", q_decimal="")
    out = mapper(spark, {"t": df}, spec, schema).derive("C").records
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "date", "string", "double", "string"]
    assert [str(v) for v in out.first()] == ["40", "2024-01-31", "x", "7.0", "None"]
    assert tuple(out.collect()[1]) == (None, None, None, None, None)


def test_range_on_a_slot_without_schema(spark, frame):
    df = frame([("40",)], ("i",))
    out = mapper(spark, {"t": df}, slots(i="{populated_from: i, range: integer}")).derive("C").records
    assert out.dtypes == [("i", "bigint")]


JOIN = """
class_derivations:
  C:
    populated_from: t
    joins: {u: {join_on: k}}
    slot_derivations:
      k: {populated_from: k}
      v: {expr: '{u.w} * 2'}
"""


def test_join_keeps_one_record_per_row(spark, frame):
    t = frame([("a",), ("b",), (None,), ("a",)], ("k",))
    u = frame([("a", "1"), ("a", "1"), ("a", "5"), (None, "9")], ("k", "w"))
    rows = {(r.k, r.v) for r in mapper(spark, {"t": t, "u": u}, JOIN).derive("C").records.collect()}
    assert rows == {(None, None), ("a", 2.0), ("b", None)}
    assert mapper(spark, {"t": t, "u": u}, JOIN).derive("C").records.count() == 4
    with pytest.raises(DataError, match="not unique"):
        mapper(spark, {"t": t, "u": u}, JOIN, strict=True).derive("C")


def test_join_errors(spark, frame):
    t, u = frame([("a",)], ("k",)), frame([("a",)], ("x",))
    with pytest.raises(SpecError, match="join key"):
        mapper(spark, {"t": t, "u": u}, JOIN, strict=True).derive("C")
    with pytest.raises(SpecError, match="join_on"):
        parse_specs([JOIN.replace("{join_on: k}", "{}")])
    with pytest.raises(SourceError):
        mapper(spark, {"t": t}, JOIN, strict=True).derive("C")


def test_one_scan_per_table_and_no_python(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(5).selectExpr("cast(id as string) a", "cast(id as string) b", "'z' unused").write.parquet(path)
    blocks = "\n---\n".join(slots(v=f"{{expr: '{{{c}}} * {n}'}}") for n, c in enumerate("abab", 1))
    m = Mapper(Catalog.parquet(spark, str(tmp_path), ["t"]), parse_specs([blocks]))
    out = m.derive("C").records
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "unused" not in plan.split("ReadSchema")[1]
    assert "Python" not in plan and "Exchange" not in plan
    assert out.count() == 20


def test_unit_conversion(spark, frame):
    df = frame([("59.5",), ("A",), (None,)], ("h",))
    ok = "{populated_from: h, unit_conversion: {source_unit: '[in_i]', target_unit: cm, none_if_non_numeric: true}}"
    got = [r.v for r in mapper(spark, {"t": df}, slots(v=ok)).derive("C").records.collect()]
    assert got[0] == pytest.approx(151.13) and got[1:] == [None, None]
    strictless = mapper(spark, {"t": df}, slots(v=ok.replace(", none_if_non_numeric: true", ""))).derive("C")
    assert [e.message for e in strictless.errors.collect()] == ["non-numeric value"]
    for bad in ("kg", "furlong"):
        with pytest.raises(SpecError):
            mapper(spark, {"t": df}, slots(v=ok.replace("cm", bad)), strict=True).derive("C")
    with pytest.raises(SpecError, match="target_unit"):
        parse_specs([slots(v="{populated_from: h, unit_conversion: {source_unit: cm}}")])


def test_nested_lists_keep_one_type(spark, frame):
    """A class with one and with two nested objects gives an array in both."""
    obj = "{{class_derivations: {{Q: {{populated_from: t, slot_derivations: {{v: {{populated_from: {c}}}}}}}}}}}"
    one = slots(q="{object_derivations: [" + obj.format(c="a") + "]}")
    two = slots(q="{object_derivations: [" + obj.format(c="a") + ", " + obj.format(c="b") + "]}")
    df = frame([("1", "2")], ("a", "b"))
    m = Mapper(Catalog.of(spark, {"t": df}), parse_specs([one, two]))
    assert [[q.v for q in r.q] for r in m.derive("C").records.collect()] == [["1"], ["1", "2"]]
    lone = Mapper(Catalog.of(spark, {"t": df}), parse_specs([one])).derive("C").records
    assert lone.dtypes == [("q", "struct<v:string>")]


def test_registered_functions(spark, frame):
    m = mapper(spark, {"t": frame([("ab",)], ("a",))}, slots(v="{expr: 'shout({a})'}"))
    m.register_function("shout", F.upper)
    assert m.derive("C").records.first().v == "AB"


def test_dotted_columns(spark, frame):
    df = frame([("P1",)], ("projects.id",))
    assert mapper(spark, {"t": df}, slots(v="{populated_from: projects.id}", w="{expr: '{projects.id} + \"!\"'}")).derive(
        "C"
    ).records.first() == ("P1", "P1!")


def test_spec_forms():
    as_dict = "class_derivations: {B: {populated_from: t}, A: {populated_from: t}}"
    as_list = "class_derivations: [{C: {populated_from: u}}, {name: D, populated_from: v}]"
    in_list = "- class_derivations: {A: {populated_from: t}}\n- class_derivations:\n- just text\n"
    specs = parse_specs([as_dict, as_list, in_list, ""])
    assert specs.entities() == ["A", "B", "C", "D"] and len(specs.blocks("A")) == 2
    assert specs.tables() == {"t", "u", "v"}
    with pytest.raises(SpecError, match="populated_from"):
        parse_specs(["class_derivations: {A: {}}"])


def test_streams_pass_through(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as string) a").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("a string").parquet(str(tmp_path / "in"))
    m = mapper(spark, {"t": stream}, slots(v="{expr: '{a} * 2'}"))
    out = stream_records(m, "C")
    assert out.isStreaming
    query = out.writeStream.format("memory").queryName("streamed").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "ck")).start()
    query.awaitTermination(60)
    assert sorted(r.v for r in spark.table("streamed").collect()) == [0.0, 2.0, 4.0]
    with pytest.raises(SpecError, match="not streams"):
        stream_records(mapper(spark, {"t": spark.read.parquet(str(tmp_path / "in"))}, slots(v="{populated_from: a}")), "C")


def test_failed_records(spark, frame):
    df = frame([("1", "k1"), ("x", "k2")], ("a", "k"))
    d = mapper(spark, {"t": df}, slots(k="{populated_from: k}", v="{expr: '{a} * 2'}")).derive("C")
    (row,) = d.failed.collect()
    assert row.k == "k2" and [(e.slot, e.message) for e in row._errors] == [("v", "non-numeric value")]
    assert mapper(spark, {"t": df}, slots(k="{populated_from: k}")).derive("C").failed.count() == 0


def test_number_cells(spark):
    from pyspark.sql import functions as F

    from slotweave.functions.values import number
    from slotweave.operators.flags import as_flag

    df = spark.createDataFrame([("5d",), ("12F",), ("Infinity",), ("nan",), (" 1.5e2 ",), ("-.5",), ("1e20",), (None,)], "c string")
    got = [tuple(r) for r in df.select(number(F.col("c")), as_flag(F.col("c"))).collect()]
    assert [n for n, _ in got] == [None, None, None, None, 150.0, -0.5, 1e20, None]
    assert [f for _, f in got][2:4] == [0, 0] and got[6][1] == 0


def test_composite_keys(spark):
    from slotweave.operators.validate import violations
    from slotweave.plans.schema import parse_schema

    schema = parse_schema("classes:\n  t:\n    unique_keys:\n      k: {unique_key_slots: [a, b]}\n    attributes: {a: {}, b: {}}\n")
    df = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "x")], "a string, b string")
    assert violations(df, "t", schema).count() == 0
    twice = violations(df.union(df.limit(1)), "t", schema).collect()
    assert [tuple(r) for r in twice] == [("t", "a, b", "duplicate", "1, x")]


def test_declared_types_and_booleans(frame):
    from slotweave.operators.validate import violations

    schema = parse_schema(
        "types:\n  Age: {typeof: Years}\n  Years: {typeof: integer}\n"
        "classes:\n  t:\n    attributes: {a: {range: Age}, b: {range: boolean}, d: {range: datetime}}\n"
    )
    assert schema.slot("t", "a").range == "integer"
    df = frame([("1", "true", "2024-01-02 03:04:05"), ("x", "maybe", "soon"), (None, None, None)], ("a", "b", "d"))
    assert sorted(tuple(r)[1:] for r in violations(df, "t", schema).collect()) == [
        ("a", "type", "x"), ("b", "type", "maybe"), ("d", "type", "soon"),
    ]


# --- large code maps ----------------------------------------------------------


def test_large_maps_share_one_broadcast(spark, frame):
    import json

    codes = {f"c{k}": f"v{k % 7}" for k in range(5000)}
    other = {f"c{k}": f"w{k}" for k in range(300)}
    slot = lambda column, mapping: {"populated_from": column, "value_mappings": mapping}
    block = {"populated_from": "t", "slot_derivations": {"a": slot("x", codes), "b": slot("y", codes), "c": slot("x", other), "d": slot("x", {"c1": "short"})}}
    df = frame([("c1", "c4999"), ("c0", None), ("none", ""), (None, "c1"), ("c1", "c4999")], ("x", "y"))
    d = mapper(spark, {"t": df}, json.dumps({"class_derivations": {"C": block}}), strict=True).derive("C")
    got = d.records
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("v1", "v1", "w1", "short"), ("v0", None, "w0", None), (None, None, None, None), (None, "v1", None, None), ("v1", "v1", "w1", "short")], key=str
    )
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    assert plan.count("ReusedExchange") == 2


def test_large_enum_mirrors_what_is_not_listed(spark, frame):
    import json

    listed = {f"T{k}": {"populated_from": f"s{k}"} for k in range(500)}
    spec = {
        "class_derivations": {"C": {"populated_from": "t", "slot_derivations": {"e": {"populated_from": "x"}}}},
        "enum_derivations": {"big": {"mirror_source": True, "permissible_value_derivations": listed}},
    }
    schema = "enums: {big: {permissible_values: {T1: {}}}}\nclasses: {C: {attributes: {e: {range: big}}}}"
    rows = mapper(spark, {"t": frame([("s3",), ("other",), (None,)], ("x",))}, json.dumps(spec), schema).derive("C").records.collect()
    assert [r.e for r in rows] == ["T3", "other", None]


# --- sums of two text columns, losses of joins, observed errors ----------------


@pytest.mark.parametrize(
    ("slot", "known", "want"),
    [("{expr: '{a} + {b}', range: string}", None, "34"), ("{expr: '{a} + {b}', range: float}", "string", 7.0), ("{expr: '{a} + {b}'}", None, 7.0),
     ("{expr: '{a} + {b}'}", "string", "34"), ("{expr: '{a} + {b}'}", "integer", 7.0), ("{expr: '{a} * 2 + {b}', range: string}", None, "10"),
     ("{expr: 'str({a} + {b})', range: string}", None, "7"), ("{expr: '{a} + {b} + {a}', range: string}", None, "343")],
)
def test_plus_goes_by_declared_then_inferred_type(spark, frame, slot, known, want):
    source = parse_schema(f"classes: {{t: {{attributes: {{a: {{range: {known}}}, b: {{range: {known}}}}}}}}}") if known else None
    d = mapper(spark, {"t": frame([("3", "4")], ("a", "b"))}, slots(v=slot), source=source).derive("C")
    assert [r.v for r in d.records.collect()] == [want] and d.errors.count() == 0


JOINED = "class_derivations: {C: {populated_from: t, joins: {u: {join_on: k}}, slot_derivations: {v: {populated_from: u.w}, z: {expr: '1 / {n}'}}}}"


def test_join_losses_are_counted(spark, frame):
    left = frame([("1", "1"), ("2", "0"), ("3", "0")], ("k", "n"))
    right = frame([("1", "b"), ("1", "a"), ("1", "a"), ("2", "c"), (None, "d"), (None, "e")], ("k", "w"))
    want = {("C", "t", "z", "division by zero", 2), ("C", "u", "k", "rows beyond the first of their join key are left out", 2)}
    d = mapper(spark, {"t": left, "u": right}, JOINED).derive("C")
    assert {tuple(r) for r in d.errors.collect()} == want
    observed, told = d.observed()
    assert observed.records.count() == 1 and {tuple(r) for r in told().collect()} == want
    unique = Catalog.of(spark, {"t": left, "u": right.filter("w = 'c'")}, unique_keys={"u": ["k"]})
    assert not Mapper(unique, parse_specs([JOINED])).derive("C").dropped


def test_observed_errors_of_empty_and_clean_tables(spark, frame):
    for rows in ([], [("1", "1")]):
        d = mapper(spark, {"t": frame(rows, ("k", "n")), "u": frame([("1", "a")], ("k", "w"))}, JOINED).derive("C")
        observed, told = d.observed()
        assert observed.records.count() == len(rows) and told().collect() == []
