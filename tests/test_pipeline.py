import glob
import json

import pytest
import yaml

from slotweave import Catalog, DataError, Options, SourceError, SpecError, list_entities, run_pipeline
from slotweave.operators.profile import InferenceOptions
from study_fixture import SUBJECTS, write_study


def text_of(path):
    return "".join(open(p).read() for p in sorted(glob.glob(f"{path}/part-*")))


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("study")
    raw, specs, schema = write_study(root)
    options = Options(
        formats=("yaml", "jsonl", "tsv", "json"), prefix="TOY", postfix="-data", inference=InferenceOptions(max_enum_size=3)
    )
    run = run_pipeline(spark, specs, schema, str(root / "out"), raw_dir=raw, options=options)
    return root, run


def docs(study, entity):
    return [d for d in yaml.safe_load_all(text_of(study[1].outputs[entity][0])) if d]


def test_only_referenced_tables_are_prepared(study):
    root, run = study
    assert {p.rsplit("/", 1)[1] for p in glob.glob(f"{root}/out/prepared/*")} == {"pht000001.parquet", "pht000002.parquet"}
    assert set(run.source_schema.classes) == {"pht000001", "pht000002"}


def test_inferred_schema(study):
    root, run = study
    slots = run.source_schema.classes["pht000001"]
    assert slots["dbGaP_Subject_ID"].identifier and slots["dbGaP_Subject_ID"].range == "integer"
    assert run.source_schema.unique_keys["pht000001"] == ("phv00000001", "phv00000005")
    assert run.source_schema.enums["phv00000006_enum"] == ("F", "M")
    assert slots["phv00000016"].range == "string"  # four values, above the enum size
    written = yaml.safe_load(text_of(f"{root}/out/SourceSchema.yaml"))
    assert written["classes"]["pht000002"]["attributes"]["phv00000013"]["range"] == "string"
    assert written["classes"]["pht000002"]["attributes"]["phv00000012"]["range"] == "float"
    assert run.validated and run.verdicts.filter("NOT passed").count() == 0


def test_output_names(study):
    assert [p.rsplit("/", 1)[1] for p in study[1].outputs["Demography"]] == [
        f"TOY-Demography--data.{f}" for f in ("yaml", "jsonl", "tsv", "json")
    ]


def test_values(study):
    people = docs(study, "Demography")
    assert len(people) == len(SUBJECTS)
    assert all(p["sex"] == p["sex_derived"] for p in people)
    assert {p["sex"] for p in people} == {"OMOP:8507", "OMOP:8532"}
    assert {p["smoking_status"] for p in people} == {"OMOP:1", "OMOP:2", "None", None}
    measures = docs(study, "MeasurementObservation")
    heights = [m for m in measures if m["observation_type"] == "HEIGHT"]
    assert 14600 in [m["age_at_observation"] for m in heights]
    assert any(m["value_quantity"]["value_decimal"] == pytest.approx(151.13) for m in heights)
    weights = [m["value_quantity"]["value_decimal"] for m in measures if m["observation_type"] == "WEIGHT"]
    assert sum(w is None for w in weights) == 2
    assert any(w == pytest.approx(61.507, abs=0.01) for w in weights if w is not None)
    assert {m["associated_visit"] for m in measures if m["observation_type"] == "HEIGHT2"} == {"A", "B", None}
    first = docs(study, "MeasurementObservationSet")[0]
    assert [o["observation_type"] for o in first["observations"]] == ["SYS", "DIA"]
    assert first["observations"][0]["value_quantity"]["unit"] == "mm[Hg]"
    assert {o["value_enum"] for o in docs(study, "Observation")} == {"None", "OMOP:40766945"}


def test_formats_agree(study):
    for entity, paths in study[1].outputs.items():
        from_yaml = [d for d in yaml.safe_load_all(text_of(paths[0])) if d]
        lines = [json.loads(x) for x in text_of(paths[1]).splitlines()]
        wrapped = json.loads(text_of(paths[3]))[f"{entity.lower()}s"]
        assert wrapped == lines
        assert len(from_yaml) == len(lines)

        def bare(x):
            if isinstance(x, dict):
                return {k: bare(v) for k, v in x.items() if v is not None}
            return [bare(v) for v in x] if isinstance(x, list) else x

        assert sorted(map(str, map(bare, from_yaml))) == sorted(map(str, lines))
    header = text_of(study[1].outputs["MeasurementObservation"][2]).splitlines()[0].split("\t")
    assert "value_quantity__value_decimal" in header


def test_no_errors_on_clean_data(study):
    assert study[1].errors.count() == 0 and study[1].violations.count() == 0


def test_lenient_run_reports_errors(spark, tmp_path):
    raw, specs, schema = write_study(tmp_path, bad=True)
    run = run_pipeline(spark, specs, schema, str(tmp_path / "out"), raw_dir=raw, options=Options(formats=("jsonl",)))
    errors = {(r.entity, r.slot, r.message.split(":")[0]): r.n for r in run.errors.collect()}
    assert errors == {
        ("Demography", "age_at_observation", "division by zero"): len(SUBJECTS),
        ("Participant", "", "Import expressions are not supported"): None,
    }
    assert len(text_of(run.outputs["Demography"][0]).splitlines()) == len(SUBJECTS)
    assert not glob.glob(str(tmp_path / "out/mapped-data/_staged"))  # one format, one pass
    twice = run_pipeline(spark, specs, schema, str(tmp_path / "two"), raw_dir=raw, options=Options(formats=("jsonl", "json")))
    assert {tuple(r) for r in twice.errors.collect()} == {tuple(r) for r in run.errors.collect()}
    assert glob.glob(str(tmp_path / "two/mapped-data/_staged/*"))


def test_strict_run_stops(spark, tmp_path):
    raw, specs, schema = write_study(tmp_path, bad=True)
    with pytest.raises(Exception, match="Import expressions|division by zero"):
        run_pipeline(spark, specs, schema, str(tmp_path / "out"), raw_dir=raw, options=Options(strict=True))


def test_ready_tables(spark, frame, tmp_path):
    _, specs, schema = write_study(tmp_path)
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "p.yaml").write_text(
        "class_derivations: {Participant: {populated_from: subject, slot_derivations: {id: {populated_from: s}}}}"
    )
    tables = Catalog.of(spark, {"subject": frame([("1",), ("1",)], ("s",)), "other": frame([("2",)], ("s",))})
    run = run_pipeline(spark, str(tmp_path / "only"), schema, str(tmp_path / "out"), tables=tables, options=Options(formats=("jsonl",)))
    assert set(run.source_schema.classes) == {"subject"}
    assert text_of(run.outputs["Participant"][0]) == '{"id":"1"}\n{"id":"1"}\n'
    with pytest.raises(SpecError, match="either"):
        run_pipeline(spark, specs, schema, str(tmp_path / "x"))


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    _, specs, schema = write_study(tmp_path / "study")
    with pytest.raises(SourceError, match="no table"):
        run_pipeline(spark, specs, schema, str(tmp_path / "out"), raw_dir=str(tmp_path / "raw"))


def test_no_specs(spark, frame, tmp_path):
    _, _, schema = write_study(tmp_path / "study")
    tables = Catalog.of(spark, {"t": frame([("1",)], ("a",))})
    run = run_pipeline(spark, str(tmp_path / "absent"), schema, str(tmp_path / "out"), tables=tables)
    assert run.outputs == {} and run.errors.count() == 0 and set(run.source_schema.classes) == {"t"}


def test_entities(spark, tmp_path):
    _, specs, _ = write_study(tmp_path)
    assert list_entities(spark, specs) == [
        "Demography", "MeasurementObservation", "MeasurementObservationSet", "Observation", "Participant",
    ]
    assert list_entities(spark, str(tmp_path / "absent")) == []


def test_validation_gate(spark, frame, tmp_path):
    from slotweave import parse_schema
    from slotweave.operators.validate import gate, verdicts, violation_counts, violations

    schema = parse_schema("classes: {t: {attributes: {a: {range: integer, identifier: true}, b: {required: true}, c: {range: date}}}}")
    df = frame([("1", "x", "2024-01-01"), ("1", None, "soon"), ("1.5", " ", None), (None, "y", "")], ("a", "b", "c"))
    found = violations(df, "t", schema)
    assert sorted((r.slot, r.rule, r.value) for r in found.collect() if r.value) == [
        ("a", "duplicate", "1"), ("a", "type", "1.5"), ("c", "type", "soon"),
    ]
    assert sorted(r.slot for r in found.filter("rule = 'required'").collect()) == ["a", "b"]
    verdict = verdicts(violation_counts(found), ["t", "clean"])
    assert gate(verdict, strict=False) is False
    assert gate(verdict.filter("passed"), strict=True) is True
    with pytest.raises(DataError, match="1 of 2 tables fail validation: t"):
        gate(verdict, strict=True)


SPEC = "class_derivations: {{Participant: {{populated_from: {table}, slot_derivations: {{id: {{populated_from: {column}}}}}}}}}"


def one_spec(tmp_path, table, column):
    _, _, schema = write_study(tmp_path / "study")
    (tmp_path / "spec").mkdir()
    (tmp_path / "spec" / "p.yaml").write_text(SPEC.format(table=table, column=column))
    return str(tmp_path / "spec"), schema


def test_delimited_files_with_replacements(spark, frame, tmp_path):
    specs, schema = one_spec(tmp_path, "my_people", "s")
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "My-People.csv").write_text('s,t\n1,"a,b"\nx,\n')
    (tmp_path / "in" / "other.tsv").write_text("s\tt\n9\t9\n")
    rules = frame([("My-People.csv", "s", "x", "2"), ("other.tsv", "s", "1", "no")], ("filename", "column_name", "original_value", "replacement_value"))
    run = run_pipeline(
        spark, specs, schema, str(tmp_path / "out"), input_dir=str(tmp_path / "in"), replacements=rules, options=Options(formats=("jsonl",))
    )
    assert set(run.source_schema.classes) == {"my_people"}
    assert sorted(text_of(run.outputs["Participant"][0]).splitlines()) == ['{"id":"1"}', '{"id":"2"}']
    for more in ({"raw_dir": "x", "input_dir": "y"}, {"raw_dir": "x", "replacements": rules}, {}):
        with pytest.raises(SpecError):
            run_pipeline(spark, specs, schema, str(tmp_path / "no"), **more)


@pytest.mark.parametrize("layout", ["markers", "blank"])
def test_archive_rows_beyond_the_header_are_reported(spark, tmp_path, layout):
    specs, schema = one_spec(tmp_path, "pht000001", "phv00000001")
    (tmp_path / "raw").mkdir()
    head = "# c\n\n##\tphv00000001.v1.p1\ndbGaP_Subject_ID\tX\n"
    for name, body in (("a", "1\tS1\n2\tS2\tlost\n3\tS3\t\n4\tS4\t\tmore\n"), ("b", "5\tS5\n")):
        (tmp_path / "raw" / f"{name}.pht000001.txt").write_text(head + body)
    options = Options(formats=("jsonl",), layout=layout, archive_pattern="*.txt")
    run = run_pipeline(spark, specs, schema, str(tmp_path / "out"), raw_dir=str(tmp_path / "raw"), options=options)
    assert len(text_of(run.outputs["Participant"][0]).splitlines()) == 5
    assert [tuple(r) for r in run.errors.collect()] == [
        ("", "pht000001", "", "rows with cells beyond the header in a.pht000001.txt", 2)
    ]
    assert set(run.source_schema.classes["pht000001"]) == {"dbGaP_Subject_ID", "phv00000001"}
