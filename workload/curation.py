"""Metadata authoring over variable rows made from the given tables."""

from pyspark.sql import functions as F

from slotweave.operators import metadata
from slotweave.operators.flags import quality_flags
from slotweave.operators.render import register_entity, render_specs
from slotweave.operators.rules import apply_rules, parse_rules
from slotweave.sinks.spec_files import placed_texts, write_spec_files
from workload.common import Registry, scratch, table

registry = Registry()

def _unit(number):
    return F.concat(F.lit("u"), number.cast("string"))


# --- reference tables ------------------------------------------------------


@registry.add("""
SELECT p_partkey AS id, lower(replace(trim(p_name), ' ', '')) AS merge_bdchm_label, trim(p_name) AS bdchm_varlabel,
       CASE WHEN p_size > 25 THEN 'OBA:' || p_size WHEN p_size > 5 THEN 'OMOP:' || p_partkey ELSE '' END AS onto_id
FROM part
""")
def reference_definitions(spark, sf_dir):
    """Definitions with the preferred ontology id and the label key."""
    raw = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("\n")).alias("bdchm_varlabel"),
        F.when(F.col("p_size") > 25, F.concat(F.lit("OBA:"), F.col("p_size").cast("string"))).alias("obacurie"),
        F.when(F.col("p_size") > 5, F.concat(F.lit("OMOP:"), F.col("p_partkey").cast("string"))).alias("omop"),
    )
    return metadata.definitions(raw)


@registry.add("""
SELECT DISTINCT CASE WHEN c_nationkey % 3 > 0 THEN 'pht' || c_nationkey END AS pht,
       'VISIT ' || (c_nationkey % 4) || ' A' AS associatedvisit, c_mktsegment AS contextvars_notes
FROM customer WHERE c_nationkey % 3 > 0
""")
def reference_context(spark, sf_dir):
    """Contextual variables: blank tables dropped, visits upper-cased, rows distinct."""
    nation = F.col("c_nationkey").cast("string")
    raw = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") % 3 > 1, F.concat(F.lit("pht"), nation))
        .when(F.col("c_nationkey") % 3 > 0, F.concat(F.lit(" pht"), nation))
        .otherwise(F.when(F.col("c_nationkey") > 9, " "))
        .alias("pht"),
        F.concat(F.lit("Visit  "), (F.col("c_nationkey") % 4).cast("string"), F.lit(" a")).alias("associatedvisit"),
        F.lit("gone").alias("datatablename"),
        F.lit(None).cast("string").alias("never"),
        F.col("c_mktsegment").alias("notes"),
    )
    return metadata.contextual_variables(raw)


@registry.add("""
WITH known AS (SELECT DISTINCT CASE s_nationkey % 2 WHEN 0 THEN 'u' ELSE 'odd' END || s_nationkey AS code FROM supplier)
SELECT DISTINCT 'u' || n_nationkey AS source_unit, 'u' || ((n_nationkey * 7) % 25) AS target_unit,
       '* ' || n_regionkey AS conversion_rule,
       CAST('u' || n_nationkey IN (SELECT code FROM known) AS INT) AS source_unit_valid,
       CAST('u' || ((n_nationkey * 7) % 25) IN (SELECT code FROM known) AS INT) AS target_unit_valid,
       CAST('u' || n_nationkey IN (SELECT code FROM known) AS INT)
         * CAST('u' || ((n_nationkey * 7) % 25) IN (SELECT code FROM known) AS INT) AS both_valid_ucums
FROM nation WHERE n_regionkey <> 3
""")
def reference_conversions(spark, sf_dir):
    """Unconditional conversion rules with the validity of both unit codes."""
    nation = table(spark, sf_dir, "nation")
    conversions = nation.select(
        F.concat(F.lit("u"), F.col("n_nationkey").cast("string")).alias("this_unit"),
        F.concat(F.lit("u"), ((F.col("n_nationkey") * 7) % 25).cast("string")).alias("that_unit"),
        F.concat(F.lit("* "), F.col("n_regionkey").cast("string")).alias("conversion_rule"),
        F.lit("x").alias("conversion_formula"),
        F.when(F.col("n_regionkey") == 3, "only then").when(F.col("n_regionkey") == 2, "").alias("conversion_condition"),
    )
    mark = F.when(F.col("s_nationkey") % 2 == 0, "u").otherwise("odd")
    ucum = table(spark, sf_dir, "supplier").select(F.concat(mark, F.col("s_nationkey").cast("string")).alias("ucum_code"))
    return metadata.unit_conversions(conversions, ucum)


@registry.add("""
SELECT DISTINCT 'u' || s_nationkey AS this_unit, 'u' || (s_nationkey % 3) AS that_unit, 1 AS equivalent_units
FROM supplier WHERE s_acctbal > 0 AND s_nationkey <> 4
""")
def reference_equivalencies(spark, sf_dir):
    """Unit pairs that are always equivalent, each once."""
    nation = F.col("s_nationkey")
    raw = table(spark, sf_dir, "supplier").select(
        F.when(nation != 4, _unit(nation)).alias("this_unit"),
        _unit(nation % 3).alias("that_unit"),
        F.when(F.col("s_acctbal") > 0, "1").otherwise("0").alias("equivalency_always"),
    )
    return metadata.unit_equivalencies(raw)


# --- rules -----------------------------------------------------------------

RULES = parse_rules([
    {"rule_type": "alias", "match_field": "cohort", "pattern": "SMALL", "target_value": "tiny"},
    {"rule_type": "alias", "match_field": "bdchm_label", "pattern": "^blue", "is_regex": "1", "target_value": "azure"},
    {"rule_type": "drop", "match_field": "bdchm_label", "pattern": "RING$", "is_regex": "1", "except_labels": "red ring;"},
    {"rule_type": "set_label", "match_field": "cohort", "pattern": "tiny", "when_label": "azure", "target_value": "tiny azure"},
    {"rule_type": "set_units", "match_field": "bdchm_label", "pattern": "tiny azure", "when_units": ";Brand#2", "target_value": "mm"},
    {"rule_type": "clear_label", "match_field": "var_units", "pattern": "brand#1\\d", "is_regex": "1", "except_labels": "azure;red ring"},
    {"rule_type": "set_units", "match_field": "bdchm_label", "pattern": "", "target_value": "none left"},
    {"rule_type": "drop", "match_field": "cohort", "pattern": "ECONOMY", "when_units": "none left"},
])


@registry.add(r"""
WITH r0 AS (SELECT p_partkey, p_type AS cohort, p_name AS bdchm_label, nullif(p_brand, 'Brand#3') AS var_units FROM part),
r1 AS (SELECT p_partkey, CASE WHEN cohort = 'SMALL' THEN 'tiny' ELSE cohort END AS cohort, bdchm_label, var_units FROM r0),
r2 AS (SELECT p_partkey, cohort, CASE WHEN regexp_matches(bdchm_label, '(?i)^blue') THEN 'azure' ELSE bdchm_label END
         AS bdchm_label, var_units FROM r1),
r3 AS (SELECT * FROM r2 WHERE NOT (regexp_matches(bdchm_label, '(?i)RING$') AND bdchm_label <> 'red ring')),
r4 AS (SELECT p_partkey, cohort, CASE WHEN cohort = 'tiny' AND bdchm_label = 'azure' THEN 'tiny azure' ELSE bdchm_label END
         AS bdchm_label, var_units FROM r3),
r5 AS (SELECT p_partkey, cohort, bdchm_label,
         CASE WHEN bdchm_label = 'tiny azure' AND coalesce(var_units, '') IN ('', 'Brand#2') THEN 'mm' ELSE var_units END
         AS var_units FROM r4),
r6 AS (SELECT p_partkey, cohort, CASE WHEN regexp_matches(coalesce(var_units, ''), '(?i)brand#1\d')
         AND bdchm_label NOT IN ('azure', 'red ring') THEN '' ELSE bdchm_label END AS bdchm_label, var_units FROM r5),
r7 AS (SELECT p_partkey, cohort, bdchm_label, CASE WHEN bdchm_label = '' THEN 'none left' ELSE var_units END AS var_units
       FROM r6)
SELECT * FROM r7 WHERE NOT (cohort = 'ECONOMY' AND coalesce(var_units, '') = 'none left')
""")
def rules_apply(spark, sf_dir):
    """Ordered cleanup rules of every type, each seeing the rows the ones before left."""
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_type").alias("cohort"),
        F.col("p_name").alias("bdchm_label"),
        F.nullif(F.col("p_brand"), F.lit("Brand#3")).alias("var_units"),
    )
    return apply_rules(rows, RULES)


# --- merge -----------------------------------------------------------------

# Units of a variable and of its definition are drawn from nation-numbered codes.
MERGE_SQL = """
WITH vars AS (
  SELECT DISTINCT 'phv' || l_partkey || 'x' || l_suppkey AS phv, 'pht' || (l_suppkey % 25) AS pht,
         lower(p_type) AS cohort, p_name AS bdchm_label, replace(p_name, ' ', '') AS merge_bdchm_label,
         CASE WHEN p_size % 5 > 0 THEN 'u' || (p_size % 7) ELSE '' END AS var_units,
         'see Exam ' || (p_size % 3) AS var_desc
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
defs AS (
  SELECT replace(p_name, ' ', '') AS merge_bdchm_label, min(p_name) AS bdchm_varname,
         CASE WHEN min(p_size) % 4 = 3 THEN 'Condition' ELSE 'MeasurementObservation' END AS bdchm_entity,
         'u' || (min(p_partkey) % 7) AS bdchm_unit,
         CASE WHEN max(p_size) % 2 = 0 THEN 'OBA:1' ELSE '' END AS onto_id
  FROM part GROUP BY 1
),
conv AS (
  SELECT 'u' || (n_nationkey % 7) AS f, 'u' || (n_nationkey // 7) AS t, '* ' || n_nationkey AS conversion_rule,
         CAST(n_nationkey % 2 AS INT) AS both_valid_ucums
  FROM nation
),
equiv AS (SELECT 'u' || n_nationkey AS f, 'u' || (n_nationkey + 1) AS t FROM nation),
over AS (SELECT CASE p_type WHEN 'SMALL' THEN p_name ELSE 'not ' || p_name END AS l, 'u1' AS f, 'u2' AS t, '* ' || max(p_partkey) AS r FROM part GROUP BY 1),
same AS (SELECT DISTINCT CASE p_type WHEN 'ECONOMY' THEN p_name ELSE 'not ' || p_name END AS l, 'u4' AS f, 'u5' AS t FROM part),
ctx AS (
  SELECT CASE WHEN n_nationkey < 22 THEN 'pht' ELSE 'other' END || n_nationkey AS pht, CASE WHEN n_regionkey < 4 THEN 'phv0' || n_nationkey END AS participantidphv,
         CASE WHEN n_regionkey % 2 = 0 THEN 'VISIT ' || n_nationkey ELSE '' END AS associatedvisit,
         CASE WHEN n_regionkey > 1 THEN 'expr' END AS associatedvisit_expr,
         CASE WHEN n_nationkey % 3 = 0 THEN 'phv1' END AS ageinyearsphv,
         CASE WHEN n_nationkey = 7 THEN '1' END AS drop_table
  FROM nation
),
joined AS (
  SELECT v.*, bdchm_varname, bdchm_entity, bdchm_unit, onto_id,
         coalesce(o.r, c.conversion_rule, '') AS conversion_rule, c.f AS source_unit, c.t AS target_unit,
         coalesce(both_valid_ucums, 0) AS both_valid_ucums,
         CASE WHEN s.l IS NOT NULL OR e.f IS NOT NULL THEN 1 ELSE 0 END AS equivalent_units,
         participantidphv, associatedvisit, ageinyearsphv, drop_table,
         CASE WHEN coalesce(associatedvisit, '') <> '' AND associatedvisit_expr IS NOT NULL THEN ''
              ELSE associatedvisit_expr END AS associatedvisit_expr
  FROM vars v LEFT JOIN defs USING (merge_bdchm_label)
  LEFT JOIN conv c ON var_units = c.f AND bdchm_unit = c.t
  LEFT JOIN equiv e ON var_units = e.f AND bdchm_unit = e.t
  LEFT JOIN over o ON bdchm_label = o.l AND var_units = o.f AND bdchm_unit = o.t
  LEFT JOIN same s ON bdchm_label = s.l AND var_units = s.f AND bdchm_unit = s.t
  LEFT JOIN ctx USING (pht)
),
flags AS (
  SELECT *, CAST(participantidphv IS NOT NULL AS INT) AS has_pht, CAST(onto_id <> '' AS INT) AS has_onto,
         CAST((var_units = bdchm_unit AND var_units <> '') OR equivalent_units = 1 AS INT) AS unit_match,
         CAST(coalesce(associatedvisit, '') <> '' AS INT) AS has_visit,
         CAST(coalesce(associatedvisit_expr, '') <> '' AS INT) AS has_visit_expr,
         CAST(ageinyearsphv IS NOT NULL AS INT) AS has_age, lower(regexp_extract(var_desc, '(?i)(exam\\s+\\d+)', 1)) AS low
  FROM joined WHERE drop_table IS DISTINCT FROM '1' AND bdchm_entity = 'MeasurementObservation'
),
units AS (
  SELECT *, CAST(unit_match = 0 AND both_valid_ucums = 1 AS INT) AS unit_convert,
         CAST(unit_match = 0 AND both_valid_ucums = 0 AND conversion_rule <> '' AS INT) AS unit_expr FROM flags
)
SELECT DISTINCT CAST(has_pht = 1 AND has_onto = 1 AND unit_match + unit_convert + unit_expr > 0 AS INT) AS row_good,
       cohort, bdchm_entity, bdchm_label, bdchm_varname, has_onto, onto_id, bdchm_unit, phv, var_desc, var_units, has_pht,
       pht, participantidphv, has_visit, associatedvisit, has_visit_expr, associatedvisit_expr,
       replace(low, 'exam', 'Exam') AS var_desc_exam, has_age, ageinyearsphv, unit_match, unit_convert, unit_expr,
       conversion_rule, 0 AS unit_casestmt, source_unit, target_unit, equivalent_units, both_valid_ucums
FROM units
"""


def _variables(spark, sf_dir):
    """One variable per (part, supplier) of the line items."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    part = table(spark, sf_dir, "part")
    joined = lines.join(part, lines.l_partkey == part.p_partkey)
    return joined.select(
        F.concat(F.lit("phv"), F.col("l_partkey").cast("string"), F.lit("x"), F.col("l_suppkey").cast("string")).alias("phv"),
        F.concat(F.lit("pht"), (F.col("l_suppkey") % 25).cast("string")).alias("pht"),
        F.lower("p_type").alias("cohort"),
        F.col("p_name").alias("bdchm_label"),
        F.when(F.col("p_size") % 5 > 0, _unit(F.col("p_size") % 7)).otherwise("").alias("var_units"),
        F.concat(F.lit("see Exam "), (F.col("p_size") % 3).cast("string")).alias("var_desc"),
    )


def _label_of(kind):
    """The label of parts of a kind; other parts get labels that no variable has."""
    label = F.when(F.col("p_type") == kind, F.col("p_name")).otherwise(F.concat(F.lit("not "), F.col("p_name")))
    return label.alias("bdchm_label")


@registry.add(MERGE_SQL)
def metadata_merge(spark, sf_dir):
    """All reference joins, label-keyed overrides, flags and the output projection."""
    part, nation = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    defs = (
        part.groupBy(F.replace("p_name", F.lit(" "), F.lit("")).alias("merge_bdchm_label"))
        .agg(F.min("p_name").alias("bdchm_varname"), F.min("p_size").alias("a"), F.max("p_size").alias("b"), F.min("p_partkey").alias("k"))
        .select(
            "merge_bdchm_label",
            "bdchm_varname",
            F.when(F.col("a") % 4 == 3, "Condition").otherwise("MeasurementObservation").alias("bdchm_entity"),
            _unit(F.col("k") % 7).alias("bdchm_unit"),
            F.when(F.col("b") % 2 == 0, "OBA:1").otherwise("").alias("onto_id"),
            F.lit("lost on collision").alias("cohort"),
        )
    )
    key = F.col("n_nationkey")
    conversions = nation.select(
        _unit(key % 7).alias("source_unit"),
        _unit(F.floor(key / 7)).alias("target_unit"),
        F.concat(F.lit("* "), key.cast("string")).alias("conversion_rule"),
        (key % 2).alias("both_valid_ucums"),
    )
    equivalencies = nation.select(
        _unit(key).alias("this_unit"), _unit(key + 1).alias("that_unit"), F.lit(1).alias("equivalent_units")
    )
    contextual = nation.select(
        F.concat(F.when(key < 22, "pht").otherwise("other"), key.cast("string")).alias("pht"),
        F.when(F.col("n_regionkey") < 4, F.concat(F.lit("phv0"), key.cast("string"))).alias("participantidphv"),
        F.when(F.col("n_regionkey") % 2 == 0, F.concat(F.lit("VISIT "), key.cast("string"))).otherwise("").alias("associatedvisit"),
        F.when(F.col("n_regionkey") > 1, "expr").alias("associatedvisit_expr"),
        F.when(key % 3 == 0, "phv1").alias("ageinyearsphv"),
        F.when(key == 7, "1").alias("drop_table"),
    )
    conversion_overrides = (
        part.groupBy(_label_of("SMALL"))
        .agg(F.concat(F.lit("* "), F.max("p_partkey").cast("string")).alias("conversion_rule"))
        .withColumns({"var_units": F.lit("u1"), "bdchm_unit": F.lit("u2")})
    )
    equivalency_overrides = (
        part.select(_label_of("ECONOMY")).distinct()
        .withColumns({"var_units": F.lit("u4"), "bdchm_unit": F.lit("u5")})
    )
    return metadata.merge_reference(
        metadata.clean.finalize(_variables(spark, sf_dir)),
        defs,
        conversions,
        equivalencies,
        contextual,
        conversion_overrides,
        equivalency_overrides,
    )


# --- curator overrides -----------------------------------------------------


@registry.add("""
WITH rows_ AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS phv, o_orderpriority AS bdchm_label, 'g' AS var_units, 'kg' AS bdchm_unit,
         o_orderstatus AS associatedvisit, CASE WHEN o_custkey % 2 = 0 THEN 'O:1' ELSE '' END AS onto_id,
         CASE WHEN o_custkey % 3 = 0 THEN 'p' ELSE '' END AS participantidphv
  FROM orders
),
fixes AS (
  SELECT CAST(c_custkey * 3 AS VARCHAR) AS phv, '1-URGENT' AS bdchm_label,
         CASE WHEN c_nationkey < 5 THEN 'kg' ELSE '' END AS u, CASE WHEN c_nationkey > 20 THEN '1' ELSE '' END AS bad,
         CASE WHEN c_nationkey % 2 = 0 THEN '* 2' ELSE '' END AS rule, CASE WHEN c_nationkey = 9 THEN '' ELSE 'px' END AS pid
  FROM customer
),
fixed AS (
  SELECT r.phv, r.bdchm_label, CASE WHEN coalesce(u, '') <> '' THEN u ELSE var_units END AS var_units, bdchm_unit,
         associatedvisit, onto_id, CASE WHEN coalesce(pid, '') <> '' THEN pid ELSE participantidphv END AS participantidphv,
         coalesce(rule, '') AS conversion_rule
  FROM rows_ r LEFT JOIN fixes f ON r.phv = f.phv AND r.bdchm_label = f.bdchm_label WHERE bad IS DISTINCT FROM '1'
)
SELECT *, CAST(participantidphv <> '' AS INT) AS has_pht, CAST(onto_id <> '' AS INT) AS has_onto,
       CAST(var_units = bdchm_unit AS INT) AS unit_match, 0 AS unit_convert,
       CAST(var_units <> bdchm_unit AND conversion_rule <> '' AS INT) AS unit_expr, 0 AS unit_casestmt, 1 AS has_visit,
       '' AS var_desc_exam, 0 AS has_age, 0 AS has_visit_expr,
       CAST(participantidphv <> '' AND onto_id <> '' AND (var_units = bdchm_unit OR conversion_rule <> '') AS INT) AS row_good
FROM fixed
""")
def override_merge(spark, sf_dir):
    """Curator fixes: values overridden, bad mappings removed, flags recomputed."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("phv"),
        F.col("o_orderpriority").alias("bdchm_label"),
        F.lit("g").alias("var_units"),
        F.lit("kg").alias("bdchm_unit"),
        F.col("o_orderstatus").alias("associatedvisit"),
        F.when(F.col("o_custkey") % 2 == 0, "O:1").alias("onto_id"),
        F.when(F.col("o_custkey") % 3 == 0, "p").alias("participantidphv"),
    )
    nation = F.col("c_nationkey")
    fixes = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") * 3).cast("string").alias("phv"),
        F.lit("1-URGENT").alias("bdchm_label"),
        F.when(nation < 5, "kg").alias("var_units_fixed"),
        F.when(nation > 20, "1").alias("bad_map"),
        F.when(nation % 2 == 0, "* 2").alias("unit_expr_custom"),
        F.when(nation != 9, "px").alias("participantidphv"),
    )
    return metadata.apply_overrides(rows, fixes)


@registry.add(r"""
WITH f AS (
  SELECT *, CAST((var_units = bdchm_unit AND var_units <> '') OR equivalent_units = '1' AS INT) AS unit_match
  FROM (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'g' WHEN 'F' THEN '' END AS var_units,
               CASE WHEN o_custkey % 2 = 0 THEN 'g' ELSE '' END AS bdchm_unit,
               CASE WHEN o_custkey % 5 = 0 THEN '1' WHEN o_custkey % 5 = 1 THEN 'x' END AS equivalent_units,
               CASE WHEN o_custkey % 7 = 0 THEN '1' ELSE '0' END AS both_valid_ucums,
               CASE WHEN o_custkey % 3 = 0 THEN '* 2' END AS conversion_rule,
               CASE WHEN o_custkey % 11 = 0 THEN 'case(x)' ELSE '' END AS unit_casestmt_custom,
               CASE WHEN o_custkey % 13 > 0 THEN 'O:1' END AS onto_id,
               CASE WHEN o_custkey % 4 = 0 THEN ' ' ELSE 'phv' END AS participantidphv,
               CASE WHEN o_custkey % 6 = 0 THEN '  ' WHEN o_custkey % 6 < 4 THEN 'V1' END AS associatedvisit,
               CASE WHEN o_custkey % 8 < 6 THEN 'e' ELSE ' ' END AS expr,
               CASE WHEN o_custkey % 9 = 0 THEN 'a' END AS ageinyearsphv,
               o_orderpriority || ' EXAM 0' || o_custkey AS var_desc FROM orders)
),
g AS (
  SELECT * EXCLUDE (unit_match, equivalent_units), coalesce(unit_match, CAST(equivalent_units = '1' AS INT), 0) AS unit_match, equivalent_units,
         CAST(trim(coalesce(associatedvisit, '')) <> '' AS INT) AS has_visit FROM f
),
h AS (
  SELECT *, CASE WHEN has_visit = 1 AND trim(expr) <> '' THEN '' ELSE expr END AS associatedvisit_expr,
         CAST(unit_match = 0 AND both_valid_ucums = '1' AS INT) AS unit_convert,
         CAST(unit_match = 0 AND both_valid_ucums = '0' AND conversion_rule IS NOT NULL AS INT) AS unit_expr,
         CAST(unit_casestmt_custom <> '' AS INT) AS unit_casestmt, CAST(trim(participantidphv) <> '' AS INT) AS has_pht,
         CAST(onto_id IS NOT NULL AS INT) AS has_onto FROM g
)
SELECT id, has_pht, has_onto, unit_match, unit_convert, unit_expr, unit_casestmt, has_visit, associatedvisit_expr,
       CAST(trim(associatedvisit_expr) <> '' AS INT) AS has_visit_expr,
       nullif(regexp_extract(var_desc, '(?i)(exam\s+\d+)', 1), '') AS var_desc_exam,
       CAST(ageinyearsphv IS NOT NULL AS INT) AS has_age,
       CAST(has_pht = 1 AND has_onto = 1 AND unit_match + unit_convert + unit_expr + unit_casestmt > 0 AS INT) AS row_good
FROM h
""")
def quality_flag_rows(spark, sf_dir):
    """Every quality flag of rows in every state."""
    k = F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "O", "g").when(F.col("o_orderstatus") == "F", "").alias("var_units"),
        F.when(k % 2 == 0, "g").otherwise("").alias("bdchm_unit"),
        F.when(k % 5 == 0, "1").when(k % 5 == 1, "x").alias("equivalent_units"),
        F.when(k % 7 == 0, "1").otherwise("0").alias("both_valid_ucums"),
        F.when(k % 3 == 0, "* 2").alias("conversion_rule"),
        F.when(k % 11 == 0, "case(x)").otherwise("").alias("unit_casestmt_custom"),
        F.when(k % 13 > 0, "O:1").alias("onto_id"),
        F.when(k % 4 == 0, " ").otherwise("phv").alias("participantidphv"),
        F.when(k % 6 == 0, "  ").when(k % 6 < 4, "V1").alias("associatedvisit"),
        F.when(k % 8 < 6, "e").otherwise(" ").alias("associatedvisit_expr"),
        F.when(k % 9 == 0, "a").alias("ageinyearsphv"),
        F.concat(F.col("o_orderpriority"), F.lit(" EXAM 0"), k.cast("string")).alias("var_desc"),
    )
    return quality_flags(rows).select(
        "id", "has_pht", "has_onto", "unit_match", "unit_convert", "unit_expr", "unit_casestmt", "has_visit",
        "associatedvisit_expr", "has_visit_expr", "var_desc_exam", "has_age", "row_good",
    )


# --- rendering -------------------------------------------------------------

MEASUREMENT_SQL = r"""
WITH r AS (SELECT p_partkey, lower(p_type) AS cohort, replace(p_name, ' ', '/') AS varname, 'pht' || p_size AS pht, 'phv' || p_partkey AS phv, p_size % 4 AS u,
                  CASE WHEN p_size % 3 > 0 THEN 'phvA' END AS age, p_size % 5 AS v FROM part)
SELECT cohort, CASE WHEN u < 3 THEN 'good' ELSE 'bad' END AS quality, regexp_replace(varname, '^.*/', '') AS varname, phv,
  '- class_derivations:' || chr(10) || '    MeasurementObservation:' || chr(10) || '      populated_from: ' || pht || chr(10)
  || '      slot_derivations:' || chr(10) || '        associated_participant:' || chr(10) || '          populated_from: phvP' || chr(10)
  || CASE WHEN v = 0 THEN '        associated_visit:' || chr(10) || '          value: V1' || chr(10)
          WHEN v = 1 THEN '        associated_visit:' || chr(10)
            || '          expr: ''uuid5("https://w3id.org/bdchm/Visit", str({phvP}) + ":" + "x")''' || chr(10) ELSE '' END
  || CASE WHEN age IS NOT NULL THEN '        age_at_observation:' || chr(10) || '          expr: ''{phvA} * 365''' || chr(10) ELSE '' END
  || '        observation_type:' || chr(10) || '          value: 0' || chr(10)
  || '        value_quantity:' || chr(10) || '          object_derivations:' || chr(10) || '          - class_derivations:' || chr(10)
  || '              Quantity:' || chr(10) || '                populated_from: ' || pht || chr(10)
  || '                slot_derivations:' || chr(10) || '                  value_decimal:' || chr(10)
  || CASE u WHEN 0 THEN '                    populated_from: ' || phv || chr(10)
       WHEN 1 THEN '                    populated_from: ' || phv || chr(10) || '                    unit_conversion:' || chr(10)
         || '                      source_unit: ''[in_i]''' || chr(10) || '                      target_unit: ''cm''' || chr(10)
       WHEN 2 THEN '                    expr: ''{' || phv || '} * 2.54''' || chr(10) ELSE '' END
  || CASE WHEN u < 3 THEN '                  unit:' || chr(10) || '                    value: ''cm''' || chr(10) ELSE '' END
  || CASE WHEN u IN (1, 2) THEN '                    range: string' || chr(10) ELSE '' END AS text
FROM r
"""


@registry.add(MEASUREMENT_SQL)
def render_measurements(spark, sf_dir):
    """Measurement specs as text, good and bad rows."""
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        F.lit("MeasurementObservation").alias("bdchm_entity"),
        F.lower("p_type").alias("cohort"),
        F.replace("p_name", F.lit(" "), F.lit("/")).alias("bdchm_varname"),
        F.concat(F.lit("pht"), size.cast("string")).alias("pht"),
        F.concat(F.lit("phv"), F.col("p_partkey").cast("string")).alias("phv"),
        F.lit("phvP").alias("participantidphv"),
        F.lit("V1").alias("associatedvisit"),
        (size % 5 == 0).cast("int").alias("has_visit"),
        F.lit('"x"').alias("associatedvisit_expr"),
        (size % 5 == 1).cast("int").alias("has_visit_expr"),
        F.when(size % 3 > 0, "phvA").alias("ageinyearsphv"),
        (size % 3 > 0).cast("int").alias("has_age"),
        F.lit("").alias("onto_id"),
        F.lit("cm").alias("bdchm_unit"),
        (size % 4 == 0).cast("int").alias("unit_match"),
        (size % 4 == 1).cast("int").alias("unit_convert"),
        (size % 4 == 2).cast("int").alias("unit_expr"),
        (size % 4 < 3).cast("int").alias("row_good"),
        F.lit("[in_i]").alias("source_unit"),
        F.lit("cm").alias("target_unit"),
        F.lit("* 2.54").alias("conversion_rule"),
    )
    return render_specs(rows, "MeasurementObservation")


CONDITION_SQL = r"""
WITH r AS (SELECT c_custkey, c_name, lower(c_mktsegment) AS cohort, c_nationkey AS n,
                  CASE WHEN c_nationkey % 4 > 0 THEN 'No=ABSENT;Don''t=UNKNOWN;skip;Yes=' || c_custkey || '=X' END AS vm FROM customer)
SELECT cohort, CASE WHEN vm IS NOT NULL AND n <> 3 THEN 'good' ELSE 'bad' END AS quality, 'v' || n AS varname, c_name AS phv,
  '- class_derivations:' || chr(10) || '    Condition:' || chr(10) || '      populated_from: pht1' || chr(10)
  || '      slot_derivations:' || chr(10) || '        associated_participant:' || chr(10)
  || '          expr: ''uuid5("https://w3id.org/bdchm/Participant", str({phvP}) + ":' || upper(cohort) || '")''' || chr(10)
  || '        associated_visit:' || chr(10) || '          expr: ''uuid5("https://w3id.org/bdchm/Visit", str({phvP}) + ":Y")''' || chr(10)
  || '        condition_concept:' || chr(10) || '          value: ''' || CASE WHEN n <> 3 THEN 'MONDO:' || n ELSE '0' END || '''' || chr(10)
  || '          range: string' || chr(10) || '        condition_status:' || chr(10) || '          populated_from: ' || c_name || chr(10)
  || CASE WHEN vm IS NOT NULL THEN '          value_mappings:' || chr(10) || '            ''No'': ABSENT' || chr(10)
       || '            ''Don''''t'': UNKNOWN' || chr(10) || '            ''Yes'': ' || c_custkey || '=X' || chr(10) ELSE '' END
  || '        condition_provenance:' || chr(10) || '          value: ''CLINICAL''' || chr(10) || '          range: string' || chr(10)
  || '        relationship_to_participant:' || chr(10) || '          value: ''' || CASE WHEN n = 5 THEN 'OMOP:5' ELSE 'ONESELF' END || '''' || chr(10)
  || '          range: string' || chr(10)
  || CASE WHEN n > 9 THEN '        associated_evidence:' || chr(10) || '          value: ''physician''''s note''' || chr(10)
       || '          range: string' || chr(10) ELSE '' END AS text
FROM r
"""


@registry.add(CONDITION_SQL)
def render_conditions(spark, sf_dir):
    """Condition specs as text: derived ids, mapping lists, quoting, defaults."""
    n = F.col("c_nationkey")
    mapped = F.concat(F.lit("No=ABSENT;Don't=UNKNOWN;skip;Yes="), F.col("c_custkey").cast("string"), F.lit("=X"))
    rows = table(spark, sf_dir, "customer").select(
        F.lit("Condition").alias("bdchm_entity"),
        F.lower("c_mktsegment").alias("cohort"),
        F.concat(F.lit("v"), n.cast("string")).alias("bdchm_varname"),
        F.lit("pht1").alias("pht"),
        F.lit("phvP").alias("participantidphv"),
        F.when(n != 3, F.concat(F.lit("MONDO:"), n.cast("string"))).alias("onto_id"),
        F.col("c_name").alias("phv"),
        F.lit("Y").alias("associatedvisit"),
        F.when(n % 4 > 0, mapped).alias("value_mappings"),
        F.lit("CLINICAL").alias("condition_provenance"),
        F.when(n > 9, "physician's note").alias("associated_evidence"),
        F.when(n == 5, "OMOP:5").otherwise("").alias("relationship_to_participant"),
    )
    return render_specs(rows, "Condition")


@registry.add(f"""
WITH d AS (SELECT cohort, quality, varname, phv, text, count(*) AS times FROM ({CONDITION_SQL}) GROUP BY ALL)
SELECT *, CAST(sum(times * strlen(text)) OVER (PARTITION BY cohort, quality, varname ORDER BY phv, text ROWS UNBOUNDED PRECEDING)
            - times * strlen(text) AS BIGINT) AS "at"
FROM d
""")
def variable_specs(spark, sf_dir):
    """Every text's place in the spec file of its cohort, quality and variable."""
    return placed_texts(render_conditions(spark, sf_dir), scratch(spark, "placed"))


@registry.add(f"""
SELECT cohort || '/' || quality || '/' || varname || '.yaml' AS file, string_agg(text, '' ORDER BY phv, text) AS text
FROM ({CONDITION_SQL}) GROUP BY cohort, quality, varname
""")
def variable_spec_files(spark, sf_dir):
    """One spec file per cohort, quality and variable, written and read back."""
    path = scratch(spark, "specs")
    write_spec_files(render_conditions(spark, sf_dir), path)
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.yaml")
    name = F.array_join(F.slice(F.split(F.col("_metadata.file_path"), "/"), -3, 3), "/")
    return files.select(name.alias("file"), F.col("value").alias("text"))


register_entity(
    "Procedure",
    lambda row: F.concat(F.lit("- procedure: '"), row.quoted("phv"), F.lit("'\n  concept: "), row.text("onto_id"), F.lit("\n")),
    lambda row: row.has("onto_id"),
)


@registry.add("""
WITH r AS (SELECT 'n' || c_nationkey AS varname, CASE WHEN c_nationkey % 3 > 0 THEN 'good' ELSE 'bad' END AS quality, c_name AS phv,
  '- procedure: ''' || c_name || '''' || chr(10) || '  concept: ' || CASE WHEN c_nationkey % 3 > 0 THEN 'P:' || c_custkey ELSE '0' END || chr(10) AS text
  FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 4 > 0)
SELECT quality || '/' || varname || '.txt' AS file, string_agg(text, '' ORDER BY phv, text) AS text FROM r GROUP BY quality, varname
""")
def registered_entity_files(spark, sf_dir):
    """An entity registered by the user, for one cohort, written in a layout of the user's choice."""
    n = F.col("c_nationkey")
    rows = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 4 > 0, "Procedure").otherwise("Condition").alias("bdchm_entity"),
        F.lower("c_mktsegment").alias("cohort"),
        F.concat(F.lit("n"), n.cast("string")).alias("bdchm_varname"),
        F.when(n % 3 > 0, F.concat(F.lit("P:"), F.col("c_custkey").cast("string"))).alias("onto_id"),
        F.col("c_name").alias("phv"),
    )
    path = scratch(spark, "layout")
    write_spec_files(render_specs(rows, "Procedure", cohort="building"), path, "{quality}/{varname}", suffix=".txt")
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt")
    name = F.array_join(F.slice(F.split(F.col("_metadata.file_path"), "/"), -2, 2), "/")
    return files.select(name.alias("file"), F.col("value").alias("text"))
