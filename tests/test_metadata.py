from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import records
from metadata_fixture import (
    CONTEXT, CONTEXT_COLUMNS, CONVERSION_COLUMNS, CONVERSIONS, DEF_COLUMNS, DEFS, EQUIVALENCIES, EXPECTED,
    EXPECTED_FIELDS, RAW, RAW_COLUMNS, RULE_COLUMNS, RULES, UCUM,
)
from slotweave.errors import DataError, SpecError
from slotweave.operators import clean
from slotweave.operators.flags import quality_flags
from slotweave.operators.metadata import OUTPUT_COLUMNS, apply_overrides, label_overrides, prepare_metadata
from slotweave.operators.rules import apply_rules, parse_rules


@pytest.fixture(scope="module")
def curated(frame):
    return prepare_metadata(
        [frame(RAW, RAW_COLUMNS)],
        frame(DEFS, DEF_COLUMNS),
        frame(CONTEXT, CONTEXT_COLUMNS),
        frame(CONVERSIONS, CONVERSION_COLUMNS),
        frame(EQUIVALENCIES, ("this_unit", "that_unit", "equivalency_always")),
        frame([(u,) for u in UCUM], ("ucum_code",)),
        parse_rules(dict(zip(RULE_COLUMNS, r)) for r in RULES),
    )


def test_golden_rows(curated):
    rows = records(curated, "cohort", "bdchm_varname", "phv")
    got = [tuple("" if r[c] is None else r[c] for c in EXPECTED_FIELDS) for r in rows]
    assert got == sorted(EXPECTED, key=lambda r: (r[0], r[2], r[5]))
    for r in rows:
        assert (r["row_good"], r["has_onto"], r["has_pht"], r["has_visit"], r["has_age"]) == (1, 1, 1, 1, 1)
        assert (r["has_visit_expr"], r["unit_expr"], r["unit_casestmt"], r["equivalent_units"]) == (0, 0, 0, 0)
        assert r["contextvars_notes"] == ("JHS baseline visit" if r["cohort"] == "jhs" else None)


def test_golden_columns(curated):
    """Columns without any value in the reference tables do not appear."""
    assert curated.columns == [c for c in OUTPUT_COLUMNS if c not in ("xassociatedvisit", "unit_casestmt_custom")]
    assert len(curated.columns) == 31


def test_merge_has_no_shuffled_join(curated):
    plan = curated._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") >= 5


def test_no_exports_gives_nothing():
    assert prepare_metadata([], None, None, None, None, None) is None


def test_column_dialects(frame):
    df = frame([("phs1", "pht1", "phv1.v1", "d")], (" Var_Report.Study_ID", "data_table.dataset_id", "var_report.variable.id", "My Col.x"))
    assert clean.normalize_columns(df).columns == ["study_id", "data_table_id", "var_id", "my_col_x"]


def test_columns_meeting_in_one_name_are_coalesced(frame):
    df = frame([(None, "b"), ("a", "c")], ("note", "notes"))
    assert [r.curator_note for r in clean.normalize_columns(df).collect()] == ["b", "a"]


def test_accession_backfill_and_cohort(frame):
    df = frame([("phv1", None), ("phv2", "phv9")], ("variable_accession", "var_id"))
    out = records(clean.normalize_columns(df), "variable_accession")
    assert [(r["var_id"], r["cohort"]) for r in out] == [("phv1", "fhs"), ("phv9", "fhs")]


def test_corrected_label(frame):
    df = frame([("a", "b"), ("a", ""), ("a", None)], ("bdchm_label", "bdchm_label_(corrected)"))
    assert [r.bdchm_label for r in clean.normalize_columns(df).collect()] == ["b", "a", "a"]


def test_standardize_categorical_and_units(frame):
    df = frame(
        [("phv1.v2", "pht1.v1", "Mg/dL ", "x", None, None), ("phv2", "pht1", None, "x", "1=a", ""), (None, None, None, "x", "1", "1")],
        ("var_id", "data_table_id", "var_units", "var_type", "enum_1", "example_1"),
    )
    rows = records(clean.standardize(df), "phv")
    assert [(r["phv"], r["pht"], r["var_units"], r["var_type"]) for r in rows] == [
        ("phv1", "pht1", "mg/dL", "x"),
        ("phv2", "pht1", "", "categorical"),
    ]
    assert "var_id" not in clean.standardize(df).columns


@pytest.mark.parametrize(
    ("given", "want"),
    [("percent", "%"), ("Pounds, to nearest pound", "[lb_av]"), ("MG / DL", "mg/dL"), ("codes", ""), ("none", ""),
     (None, ""), ("", ""), ("Furlongs per Hour", "furlongsperhour"), ("mg/L{FEU}", "mg/l{feu}"), ("Cel", "Cel")],
)
def test_unit_spellings(frame, given, want):
    df = clean.normalize_units(frame([(given,)], ("u",)), "u")
    assert df.first().u == want


def test_flags(frame):
    rows = [
        # units, target, equivalent, valid, rule, case, onto, participant
        ("g", "g", "0", "1", "* 2", "", "O:1", "p"),
        ("g", "kg", "1", "0", "", "", "O:1", "p"),
        ("g", "kg", "0", "1", "* 2", "", "O:1", "p"),
        ("g", "kg", "bad", "0", "* 2", "", "O:1", " "),
        ("", "", "0", "0", "", "case(x)", "", "p"),
        (None, None, None, None, None, None, None, None),
    ]
    names = ("var_units", "bdchm_unit", "equivalent_units", "both_valid_ucums", "conversion_rule", "unit_casestmt_custom", "onto_id", "participantidphv")
    out = quality_flags(frame([(*r, str(i)) for i, r in enumerate(rows)], (*names, "i")))
    got = [
        tuple(r[c] for c in ("unit_match", "unit_convert", "unit_expr", "unit_casestmt", "has_onto", "has_pht", "row_good"))
        for r in records(out, "i")
    ]
    assert got == [
        (1, 0, 0, 0, 1, 1, 1),
        (1, 0, 0, 0, 1, 1, 1),
        (0, 1, 0, 0, 1, 1, 1),
        (0, 0, 1, 0, 1, 0, 0),
        (0, 0, 0, 1, 0, 1, 0),
        (0, 0, 0, 0, 0, 0, 0),
    ]


def test_direct_visit_clears_the_expression(frame):
    df = frame([("V1", "x", "see Exam  12 notes"), ("", "x", "no"), (None, None, None)], ("associatedvisit", "associatedvisit_expr", "var_desc"))
    out = quality_flags(df).select("associatedvisit_expr", "has_visit", "has_visit_expr", "var_desc_exam").collect()
    assert [tuple(r) for r in out] == [("", 1, 0, "Exam  12"), ("x", 0, 1, None), (None, 0, 0, None)]


# --- rules -----------------------------------------------------------------


def rule(**kw):
    return parse_rules([{"rule_type": "drop", "match_field": "var_desc", "pattern": "", **kw}])


def test_rules_see_earlier_rules(frame):
    rules = parse_rules([
        {"rule_type": "alias", "match_field": "bdchm_label", "pattern": "a", "target_value": "b"},
        {"rule_type": "set_label", "match_field": "bdchm_label", "pattern": "b", "target_value": "c"},
        {"rule_type": "set_units", "match_field": "var_desc", "pattern": "KG", "is_regex": "1", "when_label": "c", "when_units": ";g", "target_value": "kg"},
        {"rule_type": "drop", "match_field": "var_units", "pattern": "kg"},
        {"rule_type": "clear_label", "match_field": "var_desc", "pattern": "x", "except_labels": ";keep"},
        {"rule_type": "drop", "match_field": "absent", "pattern": ""},
    ])
    df = frame([("a", "in kg", None), ("a", "x", "g"), ("keep", "x", "g"), (None, "kg", "")], ("bdchm_label", "var_desc", "var_units"))
    got = {tuple(r) for r in apply_rules(df, rules).collect()}
    assert got == {("", "x", "g"), ("keep", "x", "g"), (None, "kg", "")}


def test_many_rules_stay_linear(frame):
    rules = parse_rules(
        {"rule_type": "set_label", "match_field": "var_desc", "pattern": f"d{i}$", "is_regex": "1", "when_label": f"l{i}", "target_value": f"l{i + 1}"}
        for i in range(60)
    ) + rule(pattern="gone")
    df = frame([("l0", "d0", ""), ("l59", "d59", ""), ("l1", "gone", "")], ("bdchm_label", "var_desc", "var_units"))
    out = apply_rules(df, rules)
    assert {r.bdchm_label for r in out.collect()} == {"l1", "l60"}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_bad_rules():
    with pytest.raises(SpecError, match="invalid regex"):
        rule(pattern="(", is_regex="1")
    with pytest.raises(SpecError, match="invalid rule_type"):
        rule(rule_type="explode")
    with pytest.raises(SpecError, match="required columns"):
        parse_rules([{"rule_type": "drop"}])


# --- curator overrides -----------------------------------------------------


def test_overrides_replace_drop_and_reflag(frame):
    df = frame(
        [("phv1", "hdl", "mmol/L", "mg/dL", "O:1", "p", "", "0", "0"), ("phv2", "bmi", "u", "v", "O:1", "p", "", "0", "0"), ("phv3", "x", "u", "u", "O:1", "", "", "0", "0")],
        ("phv", "bdchm_label", "var_units", "bdchm_unit", "onto_id", "participantidphv", "conversion_rule", "equivalent_units", "both_valid_ucums"),
    )
    fixes = frame(
        [("phv1", "hdl", None, "* 38.67", None, None), ("phv2", "bmi", None, None, "1", None), ("phv3", "x", "w", None, "", "px"), ("phv9", "none", "z", None, "", "")],
        ("phv", "bdchm_label", "var_units_fixed", "unit_expr_custom", "bad_map", "participantidphv"),
    )
    rows = records(apply_overrides(df, fixes), "phv")
    assert [(r["phv"], r["var_units"], r["conversion_rule"], r["participantidphv"]) for r in rows] == [
        ("phv1", "mmol/L", "* 38.67", "p"),
        ("phv3", "w", "", "px"),
    ]
    assert [(r["unit_expr"], r["unit_match"], r["has_pht"], r["row_good"]) for r in rows] == [(1, 0, 1, 1), (0, 0, 1, 0)]


def test_override_guards(frame):
    df = frame([("p", "l")], ("phv", "bdchm_label"))
    with pytest.raises(SpecError, match="required columns"):
        apply_overrides(df, frame([("p",)], ("phv",)))
    with pytest.raises(DataError, match="duplicate"):
        apply_overrides(df, frame([("p", "l"), ("p", "l")], ("phv", "bdchm_label")))
    with pytest.raises(SpecError, match="both"):
        apply_overrides(df, frame([("p", "l", "a", "b")], ("phv", "bdchm_label", "conversion_rule", "unit_expr_custom")))
    with pytest.raises(DataError, match="conversion overrides"):
        label_overrides(frame([("l", "a", "b", "r"), ("l", "a", "b", "s")], ("bdchm_label", "var_units", "bdchm_unit", "conversion_rule")), True)


def test_whitespace_is_idempotent(frame):
    df = frame([(" a\n b\t  c ",), (None,)], ("x",))
    once = clean.clean_strings(df)
    assert [r.x for r in once.collect()] == ["a b c", None]
    assert once.collect() == clean.clean_strings(once).collect()


def test_null_columns_are_dropped(frame):
    df = frame([("a", None, None), (None, None, "b")], ("x", "y", "z"))
    assert clean.drop_null_columns(df).columns == ["x", "z"]


def test_flag_collapse(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, None)], "id int, race_a int, race_b int")
    out = clean.collapse_flags(df)
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, "race_a"), (2, "more than one race"), (3, "")]
    assert out.filter(F.col("race").isNull()).count() == 0


def test_distinct_rows_are_held_by_the_tasks_they_are_dealt_to(spark, frame):
    rows = frame([(f"phv{i % 200}", "height", "aric") for i in range(400)], ("phv", "bdchm_label", "cohort")).coalesce(1)
    done = clean.finalize(rows)
    tasks = Counter(r.task for r in done.withColumn("task", F.spark_partition_id()).collect())
    assert sum(tasks.values()) == 200 and len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    # No table of rows stands before the only exchange.
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "HashAggregate" not in plan.split("Exchange")[1]
