"""A small study in archive form, with specs over it: values are computed from the subject number."""

import gzip

SUBJECTS = range(1001, 1031)
WEIGHT_MISSING = (1005, 1010)

SCHEMA = """
name: StudyTarget
default_range: string
enums:
  sex_enum:
    permissible_values: {'OMOP:8507': {}, 'OMOP:8532': {}}
classes:
  Participant:
    attributes:
      id: {identifier: true}
      member_of_research_study:
  Demography:
    attributes:
      associated_participant:
      associated_visit:
      sex:
      sex_derived: {range: sex_enum}
      age_at_observation: {range: integer}
      smoking_status:
  MeasurementObservation:
    attributes:
      associated_participant:
      associated_visit:
      observation_type:
      method_type:
      age_at_observation: {range: integer}
      value_quantity: {range: Quantity, inlined: true}
  MeasurementObservationSet:
    attributes:
      associated_participant:
      observations: {range: MeasurementObservation, multivalued: true, required: true}
  Observation:
    attributes:
      associated_participant:
      value_enum:
  Quantity:
    attributes:
      value_decimal:
      value_concept:
      unit:
"""

QUANTITY = """
        value_quantity:
          object_derivations:
          - class_derivations:
              Quantity:
                populated_from: {table}
                slot_derivations:
                  value_decimal: {value}
                  unit: {{value: '{unit}', range: string}}
"""


def measurement(table, participant, kind, value, unit, joins="", age="", visit="value: BASELINE"):
    return f"""
- class_derivations:
    MeasurementObservation:
      populated_from: {table}
      {joins}
      slot_derivations:
        associated_participant: {{populated_from: {participant}}}
        associated_visit: {{{visit}}}
        observation_type: {{value: '{kind}', range: string}}
        {age}
{QUANTITY.format(table=table, value=value, unit=unit)}"""


SPECS = {
    "participant.yaml": """
- class_derivations:
    Participant:
      populated_from: pht000001
      slot_derivations:
        id: {populated_from: phv00000001}
        member_of_research_study: {value: phs000000}
""",
    "demography.yml": """
- class_derivations:
    Demography:
      populated_from: pht000001
      slot_derivations:
        associated_participant: {populated_from: phv00000001}
        sex:
          populated_from: phv00000002
          value_mappings: {'1': OMOP:8507, '2': OMOP:8532}
        sex_derived: {populated_from: phv00000006}
        age_at_observation: {expr: '{phv00000005} * 365'}
        smoking_status:
          populated_from: phv00000016
          value_mappings: {'1': OMOP:1, 'Former': OMOP:2, 'Unknown': None}
  enum_derivations:
    sex_enum:
      mirror_source: false
      permissible_value_derivations:
        OMOP:8507: {populated_from: M}
        OMOP:8532: {populated_from: F}
""",
    "nested/measurements.yaml": (
        measurement(
            "pht000002", "phv00000011", "HEIGHT",
            "{populated_from: phv00000012, unit_conversion: {source_unit: '[in_i]', target_unit: cm}}", "cm",
            joins="joins: {pht000001: {join_on: dbGaP_Subject_ID}}",
            age="age_at_observation: {expr: '{pht000001.phv00000005} * 365'}",
        )
        + measurement(
            "pht000002", "phv00000011", "WEIGHT",
            "{populated_from: phv00000013, unit_conversion: {source_unit: '[lb_av]', target_unit: kg, none_if_non_numeric: true}}",
            "kg",
        )
        + measurement(
            "pht000002", "phv00000011", "HEIGHT2", "{expr: '{phv00000012} * 2.54'}", "cm",
            visit="expr: 'case(({phv00000017} == 1, \"A\"), ({phv00000017} == 2, \"B\"))'",
        )
    ),
    "nested/pressure.yaml": """
- class_derivations:
    MeasurementObservationSet:
      populated_from: pht000002
      slot_derivations:
        associated_participant: {populated_from: phv00000011}
        observations:
          object_derivations:
"""
    + "".join(
        f"""
          - class_derivations:
              MeasurementObservation:
                populated_from: pht000002
                slot_derivations:
                  observation_type: {{value: '{kind}'}}
                  value_quantity:
                    object_derivations:
                    - class_derivations:
                        Quantity:
                          populated_from: pht000002
                          slot_derivations:
                            value_decimal: {{populated_from: {phv}}}
                            unit: {{value: 'mm[Hg]'}}
"""
        for kind, phv in (("SYS", "phv00000014"), ("DIA", "phv00000015"))
    ),
    "observation.yaml": """
- class_derivations:
    Observation:
      populated_from: pht000002
      slot_derivations:
        associated_participant: {populated_from: phv00000011}
        value_enum: {populated_from: phv00000018, value_mappings: {'0': None, '1': OMOP:40766945}}
""",
}

BAD_SPECS = {
    "bad_demography.yaml": """
- class_derivations:
    Demography:
      populated_from: pht000001
      slot_derivations:
        associated_participant: {populated_from: phv00000001}
        age_at_observation: {expr: '{phv00000005} / 0'}
""",
    "bad_participant.yaml": """
- class_derivations:
    Participant:
      populated_from: pht000001
      slot_derivations:
        member_of_research_study: {expr: '__import__("os").getcwd()'}
""",
}


def demographics(n):
    i = n - 1001
    smoking = ("1", "Former", "Unknown", "Never")[i % 4]
    return [n + 5000, n, 1 + i % 2, 40 + i, "MF"[i % 2], smoking]


def clinical(n):
    i = n - 1001
    weight = "A" if n in WEIGHT_MISSING else 135.6 + i
    return [n + 5000, n, 59.5 + i, weight, 110 + i, 70 + i, i % 3, i % 2]


TABLES = {
    "pht000001": (["phv00000001", "phv00000002", "phv00000005", "phv00000006", "phv00000016"], demographics),
    "pht000002": (
        ["phv00000011", "phv00000012", "phv00000013", "phv00000014", "phv00000015", "phv00000017", "phv00000018"], clinical,
    ),
    "pht000099": (["phv00000091"], lambda n: [n + 5000, "x"]),
}


def write_study(root, bad=False):
    """Archives and specs below ``root``; returns their directories."""
    raw, specs = root / "raw", root / "specs"
    raw.mkdir(parents=True)
    for table, (columns, row) in TABLES.items():
        with gzip.open(raw / f"phs000000.v1.{table}.v1.p1.c1.txt.gz", "wt") as f:
            f.write("# Study\n\n##\t" + "\t".join(f"{c}.v1.p1.c1" for c in columns) + "\n")
            f.write("dbGaP_Subject_ID\t" + "\t".join(c.upper() for c in columns) + "\n\n")
            for i, n in enumerate(SUBJECTS):
                f.write("\t".join(str(v) for v in row(n)) + "\n")
                if i == 10:
                    f.write("\n")
                if i == 20:
                    f.write("\t".join(["Intentionally Blank"] * (len(columns) + 1)) + "\n")
    for name, text in {**SPECS, **(BAD_SPECS if bad else {})}.items():
        path = specs / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    schema = root / "target.yaml"
    schema.write_text(SCHEMA)
    return str(raw), str(specs), str(schema)
