import csv

import pytest

from conftest import records
from metadata_fixture import (
    CONTEXT, CONTEXT_COLUMNS, CONVERSION_COLUMNS, CONVERSIONS, DEF_COLUMNS, DEFS, EQUIVALENCIES, EXPECTED, RAW,
    RAW_COLUMNS, RULE_COLUMNS, RULES, UCUM,
)
from slotweave import apply_override_files, generate_spec_files, parse_specs, prepare_metadata_files
from slotweave.operators.conditions import COLLAPSED, GROUP, condition_table
from slotweave.sinks.spec_files import read_spec_files
from slotweave.sources.delimited import read_metadata


def write(path, columns, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([columns, *[["" if v is None else v for v in r] for r in rows]])
    return str(path)


@pytest.fixture(scope="module")
def curated(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("authoring")
    write(root / "export" / "first.csv", ("x",), [("not this sheet",)])
    write(root / "export" / "right_join_full.csv", RAW_COLUMNS, RAW)
    return prepare_metadata_files(
        spark,
        [str(root / "export")],
        write(root / "defs.csv", DEF_COLUMNS, DEFS),
        write(root / "context.csv", CONTEXT_COLUMNS, CONTEXT),
        write(root / "conversions.csv", CONVERSION_COLUMNS, CONVERSIONS),
        write(root / "equivalencies.csv", ("this_unit", "that_unit", "equivalency_always"), EQUIVALENCIES),
        write(root / "ucum.csv", ("ucum_code",), [(u,) for u in UCUM]),
        str(root / "curated"),
        rules=write(root / "rules.csv", RULE_COLUMNS, RULES),
    )


def test_files_to_curated_table(spark, curated):
    rows = records(read_metadata(spark, curated), "cohort", "bdchm_varname")
    assert len(rows) == len(EXPECTED) and all(r["row_good"] == "1" for r in rows)
    assert prepare_metadata_files(spark, [], curated, curated, curated, curated, curated, "unused") is None


def test_fixes_and_specs(spark, curated, tmp_path):
    fixes = write(tmp_path / "fixes.csv", ("phv", "bdchm_label", "bad_map", "associatedvisit"),
                  [("phv00202900", "albumin in blood", "1", ""), ("phv00202901", "bmi", "", "ARIC EXAM 9")])
    corrected = apply_override_files(spark, curated, fixes, str(tmp_path / "corrected"))
    rows = {r["phv"]: r for r in records(read_metadata(spark, corrected))}
    assert len(rows) == len(EXPECTED) - 1 and rows["phv00202901"]["associatedvisit"] == "ARIC EXAM 9"
    out = generate_spec_files(spark, corrected, str(tmp_path / "specs"), "MeasurementObservation", "aric")
    specs = parse_specs(read_spec_files(spark, out))
    assert len(specs.blocks("MeasurementObservation")) == 8
    assert specs.tables() == {"pht004027", "pht004028"}
    assert specs.first_block("MeasurementObservation").slots[0].name == "associated_participant"


def test_condition_table(spark, frame):
    columns = (*GROUP, *COLLAPSED)
    blank = [None] * (len(COLLAPSED) - 2)
    notes = frame(
        [("1", "3", "vsd", "1", "u", "HP:2", "b", *blank), ("1", "3", "vsd", "1", "u", "HP:1", "b", *blank), ("2", "1", None, "0", "v", None, None, *blank)],
        columns,
    )
    dictionary = frame([("id", "Id (x)"), ("timepoint", "Time"), ("vsd", "Septal defect (VSD) (y)")], ("variable", "description"))
    ages = spark.createDataFrame([("1", 1, 40.5), ("1", 3, 42.0)], "id string, timepoint int, age_at_visit double")
    measures = spark.createDataFrame([("1", 1, 2.0, None), ("1", 1, 4.0, 7.0)], "id string, timepoint int, height double, sbp double")
    rows = records(condition_table(notes, dictionary, ages, measures, [1, 3]), "id")
    assert rows[0] == {
        "id": "1", "timepoint": "3", "condition_name": "vsd", "hpo_result_curie": "HP:1, HP:2", "hpo_result_label": "b",
        "mondo_result_curie": "", "mondo_result_label": "", "conditionMeasureSourceText": "Septal defect - Yes",
        "age_at_timepoint_1": "40.5", "age_at_timepoint_3": "42.0", "height_timepoint_1": "3.0", "height_timepoint_3": "",
        "sbp_timepoint_1": "7.0", "sbp_timepoint_3": "",
    }
    assert rows[1]["age_at_timepoint_1"] == "" and rows[1]["condition_name"] == ""
    found = records(condition_table(notes, dictionary, ages, measures), "id")
    assert found[0]["height_timepoint_1"] == "3.0"
