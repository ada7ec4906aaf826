"""A small curated study: 13 raw variables, reference tables, rules, and the expected table."""

RAW_COLUMNS = ("cohort", "bdchm_label", "var_id", "study_id", "data_table_id", "var_name", "var_desc", "var_units",
               "var_type", "bdchm_entity")
M = "MeasurementObservation"
RAW = [
    ("aric", "albumin in blood", "phv00202900.v1", "phs000280.v1", "pht004027.v1", "ALBUMIN", "albumin level in blood", "gm/dl", "decimal", M),
    ("aric", "bmi", "phv00202901.v1", "phs000280.v1", "pht004027.v1", "BMI", "body mass index kg/m2", None, "decimal", M),
    ("aric", "body height", "phv00202902.v1", "phs000280.v1", "pht004027.v1", "HEIGHT", "standing height", "inches", "decimal", M),
    ("aric", "body weight", "phv00202903.v1", "phs000280.v1", "pht004027.v1", "WEIGHT", "body weight", "lbs", "decimal", M),
    ("aric", "blood pressure", "phv00202904.v1", "phs000280.v1", "pht004027.v1", "SBPA", "systolic blood pressure", "mmhg", "decimal", M),
    ("aric", "blood pressure", "phv00202905.v1", "phs000280.v1", "pht004027.v1", "DBPA", "diastolic blood pressure", "mmhg", "decimal", M),
    ("aric", "hdl", "phv00202906.v1", "phs000280.v1", "pht004028.v1", "HDL", "hdl cholesterol", "mmol/L", "decimal", M),
    ("aric", "sleep hours", "phv00202907.v1", "phs000280.v1", "pht004027.v1", "SLEEP", "number of hours of sleep", None, "decimal", M),
    ("aric", "alcohol consumption", "phv00202908.v1", "phs000280.v1", "pht004027.v1", "ALCOHOL", "alcohol per week", None, "integer", M),
    ("aric", "stroke status", "phv00202909.v1", "phs000280.v1", "pht004027.v1", "STROKE", "stroke event", None, "Uriorcurie", "Condition"),
    ("aric", "glucose in blood", "phv00202910.v1", "phs000280.v1", "pht009999.v1", "GLUCOSE", "fasting glucose", "mg/dl", "decimal", M),
    ("aric", "medication adherence", "phv00202911.v1", "phs000280.v1", "pht004027.v1", "MEDADHERE", "medication adherence score", None, "decimal", M),
    ("jhs", "albumin in blood", "phv00100100.v1", "phs000286.v1", "pht001200.v1", "ALB", "serum albumin", "g/dL", "decimal", M),
]

DEF_COLUMNS = ("bdchm_entity", "bdchm_varlabel", "bdchm_varname", "bdchm_vartype", "bdchm_unit", "obacurie", "omop")
DEFS = [
    (M, "Albumin in blood", "albumin_bld", "decimal", "g/dL", "OBA:2050068", "OMOP:2212186"),
    (M, "BMI", "bmi", "decimal", "kg/m2", "OBA:2045455", "OMOP:3038553"),
    (M, "Body weight", "bdy_wgt", "decimal", "kg", "OBA:VT0001259", "OMOP:4099154"),
    (M, "Body height", "bdy_hgt", "decimal", "cm", None, "OMOP:4177340"),
    (M, "Diastolic blood pressure", "bp_diastolic", "decimal", "mm[Hg]", None, "OMOP:4154790"),
    (M, "Systolic blood pressure", "bp_systolic", "decimal", "mm[Hg]", None, "OMOP:4152194"),
    (M, "HDL", "hdl", "decimal", "mg/dL", None, "OMOP:4055865"),
    (M, "Glucose in blood", "glucose_bld", "decimal", "mg/dL", None, "OMOP:4144235"),
    (M, "Sleep hours", "sleep_hours", "decimal", "h", None, "OMOP:40762499"),
    (M, "Alcohol servings", "alcohol_servings", "integer", "{#}/wk", None, "OMOP:35609491"),
    ("Condition", "Stroke", "stroke", "Uriorcurie", None, None, "OMOP:443454"),
]

CONTEXT_COLUMNS = ("cohort", "pht", "datatablename", "associatedvisit", "associatedvisit_expr", "xassociatedvisit",
                   "participantidphv", "ageinyearsphv", "ageinyears_expr", "notes", "drop_table")
CONTEXT = [
    ("ARIC", "pht004027", "ARIC_Exam1", "ARIC EXAM 1", None, None, "phv00202851", "phv00202852", None, None, None),
    ("ARIC", "pht004028", "ARIC_Exam3", "ARIC EXAM 3", None, None, "phv00202861", "phv00202862", None, None, None),
    ("JHS", "pht001200", "JHS_Visit1", "JHS VISIT 1", None, None, "phv00100001", "phv00100002", None, "JHS baseline visit", None),
    ("JHS", "pht001201", "JHS_Visit2", None, "Visit_2_label", None, "phv00100011", "phv00100012", None, None, None),
    ("FHS", "pht000001", "FHS_Exam1", "FHS EXAM 1", None, None, "phv00000101", "phv00000102", None, None, None),
    ("ARIC", "pht009999", "ARIC_Dropped", None, None, None, None, None, None, None, "1"),
]

CONVERSION_COLUMNS = ("this_unit", "that_unit", "conversion_rule", "conversion_formula", "conversion_condition")
CONVERSIONS = [
    ("[in_us]", "cm", "* 2.54", None, None),
    ("[lb_av]", "kg", "* 0.453592", None, None),
    ("mmol/L", "mg/dL", "* 38.67", None, None),
]
EQUIVALENCIES = [("meq/L", "mmol/L", "1")]
UCUM = ["cm", "kg", "g/dL", "mg/dL", "mm[Hg]", "%", "kg/m2", "h", "[in_us]", "[lb_av]", "mmol/L", "{#}/wk", "{#}/d", "meq/L"]

RULE_COLUMNS = ("rule_type", "match_field", "pattern", "is_regex", "when_label", "when_units", "except_labels", "target_value")
RULES = [
    ("alias", "cohort", "hchs/sol", "", "", "", "", "hchs_sol"),
    ("alias", "bdchm_label", "stroke status", "", "", "", "", "stroke"),
    ("alias", "bdchm_label", "alcohol consumption", "", "", "", "", "alcohol servings"),
    ("drop", "bdchm_label", "medication adherence", "", "", "", "", ""),
    ("clear_label", "var_desc", "visit type", "", "", "", "", ""),
    ("clear_label", "var_desc", r"^days |days since| date$|^age|age at|\(years\)", "1", "", "", "death;age at follow-up", ""),
    ("set_label", "var_desc", "diastolic", "1", "blood pressure", "", "", "diastolic blood pressure"),
    ("set_label", "var_desc", "systolic", "1", "blood pressure", "", "", "systolic blood pressure"),
    ("set_units", "var_desc", "per week|weekly|serv/week", "1", "alcohol servings;fruit servings", ";{servings}", "", "{#}/wk"),
    ("set_units", "var_desc", "how many hours|number of hours|hours", "1", "sleep hours", ";", "", "h"),
    ("set_units", "var_desc", "kg/m2", "1", "", ";", "", "kg/m2"),
]

# cohort, label, varname, onto_id, unit, phv, var_units, pht, participant, visit, age, match, convert, rule, source, target, valid
EXPECTED = [
    ("aric", "albumin in blood", "albumin_bld", "OBA:2050068", "g/dL", "phv00202900", "g/dL", "pht004027", "phv00202851", "ARIC EXAM 1", "phv00202852", 1, 0, "", "", "", 0),
    ("aric", "alcohol servings", "alcohol_servings", "OMOP:35609491", "{#}/wk", "phv00202908", "{#}/wk", "pht004027", "phv00202851", "ARIC EXAM 1", "phv00202852", 1, 0, "", "", "", 0),
    ("aric", "body height", "bdy_hgt", "OMOP:4177340", "cm", "phv00202902", "[in_us]", "pht004027", "phv00202851", "ARIC EXAM 1", "phv00202852", 0, 1, "* 2.54", "[in_us]", "cm", 1),
    ("aric", "body weight", "bdy_wgt", "OBA:VT0001259", "kg", "phv00202903", "[lb_av]", "pht004027", "phv00202851", "ARIC EXAM 1", "phv00202852", 0, 1, "* 0.453592", "[lb_av]", "kg", 1),
    ("aric", "bmi", "bmi", "OBA:2045455", "kg/m2", "phv00202901", "kg/m2", "pht004027", "phv00202851", "ARIC EXAM 1", "phv00202852", 1, 0, "", "", "", 0),
    ("aric", "diastolic blood pressure", "bp_diastolic", "OMOP:4154790", "mm[Hg]", "phv00202905", "mm[Hg]", "pht004027", "phv00202851", "ARIC EXAM 1", "phv00202852", 1, 0, "", "", "", 0),
    ("aric", "systolic blood pressure", "bp_systolic", "OMOP:4152194", "mm[Hg]", "phv00202904", "mm[Hg]", "pht004027", "phv00202851", "ARIC EXAM 1", "phv00202852", 1, 0, "", "", "", 0),
    ("aric", "hdl", "hdl", "OMOP:4055865", "mg/dL", "phv00202906", "mmol/L", "pht004028", "phv00202861", "ARIC EXAM 3", "phv00202862", 0, 1, "* 38.67", "mmol/L", "mg/dL", 1),
    ("aric", "sleep hours", "sleep_hours", "OMOP:40762499", "h", "phv00202907", "h", "pht004027", "phv00202851", "ARIC EXAM 1", "phv00202852", 1, 0, "", "", "", 0),
    ("jhs", "albumin in blood", "albumin_bld", "OBA:2050068", "g/dL", "phv00100100", "g/dL", "pht001200", "phv00100001", "JHS VISIT 1", "phv00100002", 1, 0, "", "", "", 0),
]
EXPECTED_FIELDS = ("cohort", "bdchm_label", "bdchm_varname", "onto_id", "bdchm_unit", "phv", "var_units", "pht",
                   "participantidphv", "associatedvisit", "ageinyearsphv", "unit_match", "unit_convert",
                   "conversion_rule", "source_unit", "target_unit", "both_valid_ucums")
