import glob
from collections import Counter

import pytest
import yaml
from pyspark.sql import functions as F

from conftest import records
from slotweave import Catalog, Mapper, SpecError, parse_specs
from slotweave.operators.render import register_entity, render_specs
from slotweave.sinks.spec_files import layout_columns, read_spec_files, write_spec_files
from slotweave.sinks.writers import write_quoted_csv

COLUMNS = ("bdchm_entity", "cohort", "bdchm_varname", "row_good", "pht", "participantidphv", "associatedvisit", "has_visit",
           "has_visit_expr", "associatedvisit_expr", "ageinyearsphv", "has_age", "onto_id", "phv", "bdchm_unit", "unit_match",
           "unit_convert", "unit_expr", "unit_casestmt", "source_unit", "target_unit", "conversion_rule", "unit_casestmt_custom")
M = "MeasurementObservation"
MEASUREMENTS = [
    (M, "aric", "albumin_bld", "1", "t", "p", "V1", "1", "0", None, "age", "1", "O:1", "a", "g/dL", "1", "0", "0", "0", None, None, None, None),
    (M, "aric", "bdy_hgt", "1", "t", "p", "V1", "1", "0", None, "age", "1", "O:2", "b", "cm", "0", "1", "0", "0", "in", "cm", None, None),
    (M, "aric", "bdy_wgt", "1", "t", "p", None, "0", "1", '"x"', None, "0", "O:3", "c", "kg", "0", "0", "1", "0", None, None, "* 0.5", None),
    (M, "aric", "waist", "1", "t", "p", None, "0", "0", None, None, "0", "O:4", "d", "cm", "0", "0", "0", "1", None, None, None, "case(({d} == 1, {d} * 2))"),
    (M, "aric", "deep/hemo_a1c", "0", "t", "p", None, "0", "0", None, None, "0", "O:5", "e", "%", "0", "0", "0", "0", None, None, None, None),
    (M, "jhs", "bdy_hgt", "1", "t", "p", "V1", "1", "0", None, None, "0", "O:2", "b", "cm", "1", "0", "0", "0", None, None, None, None),
    ("Condition", "aric", "x", "1", "t", "p", "V1", "1", "0", None, None, "0", "O:2", "b", "cm", "1", "0", "0", "0", None, None, None, None),
]


def test_routing(frame):
    rows = records(render_specs(frame(MEASUREMENTS, COLUMNS), M, "aric"), "varname")
    assert [(r["varname"], r["quality"]) for r in rows] == [
        ("albumin_bld", "good"), ("bdy_hgt", "good"), ("bdy_wgt", "good"), ("hemo_a1c", "bad"), ("waist", "good"),
    ]


def test_measurement_text(frame):
    rows = {r["varname"]: yaml.safe_load(r["text"])[0]["class_derivations"][M] for r in records(render_specs(frame(MEASUREMENTS, COLUMNS), M, "aric"))}

    def quantity(name):
        return rows[name]["slot_derivations"]["value_quantity"]["object_derivations"][0]["class_derivations"]["Quantity"]["slot_derivations"]

    assert rows["albumin_bld"]["slot_derivations"]["age_at_observation"] == {"expr": "{age} * 365"}
    assert quantity("albumin_bld") == {"value_decimal": {"populated_from": "a"}, "unit": {"value": "g/dL"}}
    assert quantity("bdy_hgt") == {
        "value_decimal": {"populated_from": "b", "unit_conversion": {"source_unit": "in", "target_unit": "cm"}},
        "unit": {"value": "cm", "range": "string"},
    }
    assert quantity("bdy_wgt")["value_decimal"] == {"expr": "{c} * 0.5"}
    assert quantity("waist")["value_decimal"] == {"expr": "case(({d} == 1, {d} * 2))"}
    assert "associated_visit" not in rows["waist"]["slot_derivations"]
    assert rows["bdy_wgt"]["slot_derivations"]["associated_visit"]["expr"] == (
        'uuid5("https://w3id.org/bdchm/Visit", str({p}) + ":" + "x")'
    )


def test_rendered_specs_can_be_derived(spark, frame, tmp_path):
    """Render, write, read back, parse and derive: the text is a working spec."""
    rendered = render_specs(frame(MEASUREMENTS, COLUMNS), M).filter("quality = 'good'")
    write_spec_files(rendered, str(tmp_path / "specs"))
    dirs = {p[len(str(tmp_path / "specs")) + 1 :] for p in glob.glob(f"{tmp_path}/specs/*/*/*")}
    assert {"aric/good/bdy_hgt.yaml", "jhs/good/bdy_hgt.yaml"} <= dirs and not any("." in d.replace(".yaml", "") for d in dirs)
    specs = parse_specs(read_spec_files(spark, str(tmp_path / "specs")))
    assert len(specs.blocks(M)) == 5
    t = frame([("s1", "41", "1", "10", "100", "1", "7")], ("p", "age", "a", "b", "c", "d", "e"))
    out = records(Mapper(Catalog.of(spark, {"t": t}), specs, strict=True).derive(M).records, "observation_type", "associated_visit")
    got = sorted((r["observation_type"], r["value_quantity"]["value_decimal"], r["value_quantity"]["unit"]) for r in out)
    assert got == [("O:1", "1", "g/dL"), ("O:2", "10", "cm"), ("O:2", "25.4", "cm"), ("O:3", "50", "kg"), ("O:4", "2", "cm")]


CONDITION_COLUMNS = ("bdchm_entity", "cohort", "bdchm_varname", "pht", "participantidphv", "onto_id", "phv", "associatedvisit",
                     "value_mappings", "condition_provenance", "associated_evidence", "relationship_to_participant")
CONDITIONS = [
    ("Condition", "chs", "copd", "t", "p", "MONDO:1", "a", "BASE", "0=ABSENT;1=PRESENT", "SELF", "form", None),
    ("Condition", "chs", "quoted", "t", "p", "MONDO:2", "b", "Y5", "No=ABSENT;Don't know=UNKNOWN;Yes=PRESENT;", "SELF", "physician's note", None),
    ("Condition", "chs", "family", "t", "p", "MONDO:3", "a", "BASE", "0=ABSENT;1=A=B", "SELF", None, "OMOP:9"),
    ("Condition", "chs", "incomplete", "t", "p", None, "a", "BASE", "0=ABSENT", "SELF", None, None),
    ("Condition", "chs", "novmap", "t", "p", "MONDO:4", "a", "BASE", None, "SELF", None, None),
]


def test_conditions(spark, frame):
    rendered = render_specs(frame(CONDITIONS, CONDITION_COLUMNS), "Condition", "chs")
    rows = {r["varname"]: (r["quality"], yaml.safe_load(r["text"])[0]["class_derivations"]["Condition"]["slot_derivations"]) for r in records(rendered)}
    assert {k for k, (q, _) in rows.items() if q == "bad"} == {"incomplete", "novmap"}
    assert rows["quoted"][1]["condition_status"]["value_mappings"] == {"No": "ABSENT", "Don't know": "UNKNOWN", "Yes": "PRESENT"}
    assert rows["quoted"][1]["associated_evidence"]["value"] == "physician's note"
    assert rows["family"][1]["condition_status"]["value_mappings"]["1"] == "A=B"
    assert rows["family"][1]["relationship_to_participant"]["value"] == "OMOP:9"
    assert rows["copd"][1]["relationship_to_participant"]["value"] == "ONESELF"
    assert "associated_evidence" not in rows["family"][1]
    assert ":CHS" in rows["copd"][1]["associated_participant"]["expr"]
    assert "value_mappings" not in rows["novmap"][1]["condition_status"]
    good = [r["text"] for r in records(rendered) if r["quality"] == "good"]
    t = frame([("s1", "1", "Don't know"), ("s2", "9", None)], ("p", "a", "b"))
    out = Mapper(Catalog.of(spark, {"t": t}), parse_specs(good), strict=True).derive("Condition").records
    assert out.count() == 6 and out.filter(F.col("condition_status") == "UNKNOWN").count() == 1


def test_unknown_and_registered_entities(frame):
    df = frame([("Thing", "c", "v", "x")], ("bdchm_entity", "cohort", "bdchm_varname", "phv"))
    with pytest.raises(SpecError, match="no registered entity"):
        render_specs(df, "Thing")
    register_entity("Thing", lambda row: F.concat(F.lit("thing "), row.text("phv")), lambda row: row.has("phv"))
    assert records(render_specs(df, "Thing")) == [{"cohort": "c", "quality": "good", "varname": "v", "phv": "x", "text": "thing x"}]


def test_layouts(frame, tmp_path):
    assert layout_columns("{cohort}/{quality}/{varname}.yaml") == ["cohort", "quality", "varname"]
    assert layout_columns("{quality}/{varname}") == ["quality", "varname"]
    for bad in ("/abs/{varname}", "../{varname}", "{cohort}/../../{varname}", "", "{nope}", "file:/x/{varname}"):
        with pytest.raises(SpecError):
            layout_columns(bad)
    row = frame([("c", "good", "..", "p", "t")], ("cohort", "quality", "varname", "phv", "text"))
    with pytest.raises(SpecError, match="leave its directory"):
        write_spec_files(row, str(tmp_path / "x"))


def test_quoted_csv(spark, frame, tmp_path):
    write_quoted_csv(frame([('a "b", c', None)], ("x", "y")).coalesce(1), str(tmp_path / "q"))
    text = "".join(open(p).read() for p in sorted(glob.glob(f"{tmp_path}/q/part-*")))
    assert text == '"x","y"\n"a ""b"", c",""\n'


def test_rows_of_one_task_are_rendered_by_many(spark, frame):
    rows = frame([("Condition", "aric", f"v{i % 3}", f"phv{i}") for i in range(400)], ("bdchm_entity", "cohort", "bdchm_varname", "phv")).coalesce(1)
    rendered = render_specs(rows, "Condition").withColumn("task", F.spark_partition_id()).collect()
    tasks = Counter(r.task for r in rendered)
    assert len(rendered) == 400 and len({r.phv for r in rendered}) == 400
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1 and max(tasks.values()) < 200
