"""Cleaning, reshaping and lookup operators over the given tables."""

from pyspark.sql import functions as F

from slotweave.functions.text import exam_mention, source_text
from slotweave.functions.units import normalize_units
from slotweave.operators import clean
from slotweave.operators.conditions import COLLAPSED, condition_table
from slotweave.operators.curies import curie_audit, curie_inventory, remap_curies
from slotweave.operators.joins import duplicate_keys
from slotweave.operators.replace import replace_cells
from slotweave.operators.reshape import (
    distinct_spellings,
    join_distinct_text,
    latest_version,
    pivot_mean,
    pivot_unique,
    union_distinct,
)
from workload.common import Registry, table

registry = Registry()

WHITE = r"[\s\x0b\x{85}\p{Z}]+"


@registry.add(f"""
SELECT doc_id, trim(regexp_replace(text, '{WHITE}', ' ', 'g')) AS text, trim(regexp_replace(lang, '{WHITE}', ' ', 'g')) AS lang
FROM documents
""")
def clean_whitespace(spark, sf_dir):
    """White space of every text column, whole texts."""
    return clean.clean_strings(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


@registry.add("""
SELECT 'phv' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phv, 'phs' || CAST(c_nationkey AS VARCHAR) AS phs,
       'pht' || CAST(c_nationkey AS VARCHAR) AS pht, lower(c_mktsegment) AS cohort, lower(c_name) AS bdchm_label,
       CASE c_nationkey % 4 WHEN 0 THEN 'mg/dL' WHEN 1 THEN '[lb_av]' WHEN 2 THEN '' ELSE 'odd' || lower(c_mktsegment) END
           AS var_units,
       CASE WHEN c_nationkey < 5 OR c_acctbal < 0 THEN 'categorical' ELSE 'decimal' END AS var_type,
       CASE WHEN c_nationkey < 5 THEN '1=a' END AS enum_1, CASE WHEN c_acctbal < 0 THEN 'x' ELSE '' END AS example_1
FROM customer WHERE c_mktsegment <> 'FURNITURE'
""")
def clean_accession(spark, sf_dir):
    """Raw variable rows standardized: accessions, case, units, categorical type, blank keys dropped."""
    key = F.col("c_custkey").cast("string")
    nation = F.col("c_nationkey").cast("string")
    unit = (
        F.when(F.col("c_nationkey") % 4 == 0, "MG per DL")
        .when(F.col("c_nationkey") % 4 == 1, "Pounds")
        .when(F.col("c_nationkey") % 4 == 2, "Codes")
        .otherwise(F.concat(F.lit("Odd "), F.col("c_mktsegment")))
    )
    raw = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_mktsegment") != "FURNITURE", F.concat(F.lit("phv"), F.lpad(key, 8, "0"), F.lit(".v1.p2"))).alias("var_id"),
        F.lit("again").alias("var_id_note"),
        F.concat(F.lit("phs"), nation, F.lit(".v3")).alias("study_id"),
        F.concat(F.lit("pht"), nation, F.lit(".v1")).alias("data_table_id"),
        F.col("c_mktsegment").alias("cohort"),
        F.col("c_name").alias("bdchm_label"),
        unit.alias("var_units"),
        F.lit("decimal").alias("var_type"),
        F.when(F.col("c_nationkey") < 5, "1=a").alias("enum_1"),
        F.when(F.col("c_acctbal") < 0, "x").otherwise("").alias("example_1"),
        F.lit("dropped").alias("bdchm_variable"),
    )
    return clean.standardize(raw)


@registry.add("""
SELECT CASE WHEN o_orderstatus = 'O' THEN 's' || o_orderkey ELSE 'a' || o_custkey END AS study_id,
       'a' || o_custkey AS dbgap_study_accession, 'v' || o_orderkey AS variable_accession, 'v' || o_orderkey AS var_id,
       CASE WHEN o_orderstatus = 'F' THEN 'fixed' ELSE o_orderpriority END AS bdchm_label,
       CASE o_orderstatus WHEN 'F' THEN 'fixed' WHEN 'P' THEN '' END AS bdchm_label_corrected,
       coalesce(CASE WHEN o_custkey % 2 = 0 THEN 'note' END, o_orderpriority) AS curator_note,
       o_orderstatus AS my_col_x, 'fhs' AS cohort
FROM orders
""")
def clean_backfill(spark, sf_dir):
    """Export column names normalized, accessions backfilled, labels corrected."""
    orders = table(spark, sf_dir, "orders")
    accession = F.concat(F.lit("a"), F.col("o_custkey").cast("string"))
    raw = orders.select(
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("s"), F.col("o_orderkey").cast("string"))).alias(" Var_Report.Study_ID"),
        accession.alias("dbGaP_Study_Accession"),
        F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("variable_accession"),
        F.col("o_orderpriority").alias("BDCHM_Label"),
        F.when(F.col("o_orderstatus") == "F", "fixed").when(F.col("o_orderstatus") == "P", "").alias("bdchm_label_(corrected)"),
        F.when(F.col("o_custkey") % 2 == 0, "note").alias("Note"),
        F.col("o_orderpriority").alias("Notes"),
        F.col("o_orderstatus").alias("My Col.x"),
    )
    return clean.normalize_columns(raw)


@registry.add("SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_null_cols(spark, sf_dir):
    """Columns without any value dropped after one aggregate pass."""
    customer = table(spark, sf_dir, "customer")
    never = F.when(F.col("c_custkey") < 0, F.col("c_name"))
    wide = customer.select("c_custkey", never.alias("empty_a"), "c_name", F.lit(None).cast("int").alias("empty_b"), "c_nationkey")
    return clean.drop_null_columns(wide)


@registry.add("""
SELECT p_partkey,
       CASE p_partkey % 10 WHEN 0 THEN 'mg/dL' WHEN 1 THEN '[lb_av]' WHEN 2 THEN '[in_us]' WHEN 3 THEN '' WHEN 4 THEN ''
         WHEN 5 THEN '{beats}/min' WHEN 6 THEN '' WHEN 7 THEN '%' WHEN 8 THEN '10*3/uL'
         ELSE lower(replace(p_name, ' ', '')) END AS unit
FROM part
""")
def unit_alias(spark, sf_dir):
    """Unit spellings to canonical units by the alias table."""
    spellings = ["Mg/100 mL", "LBS", "inches, to next lower 1/4 inch", "codes", "None", "Beats per Minute", None, "Percent", "10^3 cells/uL"]
    key = F.col("p_partkey") % 10
    unit = F.when(key == 9, F.col("p_name"))
    for i, s in enumerate(spellings):
        unit = unit.when(key == i, F.lit(s))
    return normalize_units(table(spark, sf_dir, "part").select("p_partkey", unit.alias("unit")), "unit")


@registry.add("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'O' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'top' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def replace_cells_few(spark, sf_dir):
    """A short rule table: later rules win, a replacement is not replaced again."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    statuses = orders.select(F.col("o_orderstatus").alias("v")).distinct()
    priorities = orders.select(F.col("o_orderpriority").alias("v")).distinct()
    new_status = F.when(F.col("v") == "F", "O").when(F.col("v") == "O", "open").otherwise(F.col("v"))
    rules = (
        statuses.select(F.lit("o_orderstatus").alias("column_name"), "v", F.lit("first").alias("new"), F.lit(0).alias("ordinal"))
        .unionAll(statuses.select(F.lit("o_orderstatus"), "v", new_status, F.lit(1)))
        .unionAll(priorities.filter("v < '3'").select(F.lit("o_orderpriority"), "v", F.lit("top"), F.lit(2)))
        .select(F.lit("orders").alias("filename"), "column_name", F.col("v").alias("original_value"), F.col("new").alias("replacement_value"), "ordinal")
    )
    other = rules.withColumn("filename", F.lit("other")).withColumn("replacement_value", F.lit("never"))
    return replace_cells(orders, rules.unionAll(other), "orders")


@registry.add("""
SELECT o_orderkey, coalesce('holder ' || c_mktsegment, CAST(o_custkey AS VARCHAR)) AS o_custkey
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey > 5) ON o_custkey = c_custkey
""")
def replace_cells_many(spark, sf_dir):
    """A rule table as long as the customer table; rules of another file don't count."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rules = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") > 5, "orders").otherwise("other").alias("filename"),
        F.lit("o_custkey").alias("column_name"),
        F.col("c_custkey").cast("string").alias("original_value"),
        F.concat(F.lit("holder "), F.col("c_mktsegment")).alias("replacement_value"),
        F.lit(0).alias("ordinal"),
    )
    return replace_cells(orders, rules, "orders")


@registry.add("""
SELECT p_partkey,
       CASE WHEN n > 1 THEN 'more than one race' WHEN a = 1 THEN 'race_small' WHEN b = 1 THEN 'race_big'
            WHEN c = 1 THEN 'race_red' ELSE '' END AS race
FROM (SELECT *, a + b + c AS n FROM (
  SELECT p_partkey, CAST(p_type = 'SMALL' AS INT) AS a, CAST(p_size > 40 AS INT) AS b,
         CAST(starts_with(p_name, 'red') AS INT) AS c FROM part))
""")
def race_collapse(spark, sf_dir):
    """0/1 flag columns to one category."""
    flags = table(spark, sf_dir, "part").select(
        "p_partkey",
        (F.col("p_type") == "SMALL").cast("int").alias("race_small"),
        (F.col("p_size") > 40).cast("int").alias("race_big"),
        F.col("p_name").startswith("red").cast("int").alias("race_red"),
    )
    return clean.collapse_flags(flags)


@registry.add("""
SELECT p_partkey, trim(p_name || ' ') || ' - Yes' AS source_text FROM part
""")
def text_prefix(spark, sf_dir):
    """Text before the first parenthesis with a fixed suffix."""
    described = F.concat(F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(") ("), F.col("p_brand"), F.lit(")"))
    return table(spark, sf_dir, "part").select("p_partkey", source_text(described).alias("source_text"))


@registry.add(r"""
SELECT doc_id, nullif(regexp_extract(CASE WHEN n_chars % 3 = 0 THEN text || ' eXam  ' || n_chars || ' exam 1' ELSE text END,
                                     '(?i)(exam\s+\d+)', 1), '') AS exam
FROM documents
""")
def exam_extract(spark, sf_dir):
    """First exam mention of a text, null without one."""
    tail = F.concat(F.col("text"), F.lit(" eXam  "), F.col("n_chars").cast("string"), F.lit(" exam 1"))
    text = F.when(F.col("n_chars") % 3 == 0, tail).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", exam_mention(text).alias("exam"))


CURIE = r"\b([A-Z][A-Za-z0-9]*:[A-Za-z0-9]+)\b"
# Each document ends with two CURIEs of its own making.
TAGGED = "text || ' Lang:' || lang || ' S:' || source || '; x'"


def _tagged(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = F.concat(F.col("text"), F.lit(" Lang:"), F.col("lang"), F.lit(" S:"), F.col("source"), F.lit("; x"))
    return docs.select("doc_id", "source", text.alias("text"))


@registry.add(f"""
SELECT curie, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(html, '{CURIE}', 1)) AS curie FROM pages
  UNION ALL SELECT unnest(regexp_extract_all({TAGGED}, '{CURIE}', 1)) FROM documents)
GROUP BY curie
""")
def curie_list(spark, sf_dir):
    """Distinct CURIEs of pages and documents with their mentions."""
    texts = table(spark, sf_dir, "pages").select(F.col("html").alias("text")).unionAll(_tagged(spark, sf_dir).select("text"))
    return curie_inventory(texts, "text")


@registry.add(f"""
SELECT source, count(*) AS n_rows, CAST(sum(m) AS BIGINT) AS n_mentions
FROM (SELECT source, len(regexp_extract_all({TAGGED}, '{CURIE}', 1)) AS m FROM documents) WHERE m > 0 GROUP BY source
""")
def curie_residuals(spark, sf_dir):
    """Sources that still hold CURIEs."""
    return curie_audit(_tagged(spark, sf_dir), "text", "source")


def _remap_sql(case: str) -> str:
    marked = f"regexp_replace({TAGGED}, '{CURIE}', chr(1) || '\\1' || chr(1), 'g')"
    return f"""
    SELECT doc_id, source, list_aggregate(
      list_transform(string_split({marked}, chr(1)), lambda t: {case}), 'string_agg', '') AS text FROM documents
    """


@registry.add(_remap_sql("CASE t WHEN 'Lang:fr' THEN 'ISO:french' WHEN 'Lang:en' THEN 'Lang:fr' ELSE t END"))
def curie_remap(spark, sf_dir):
    """Listed CURIEs replaced in one pass, token by token."""
    langs = table(spark, sf_dir, "documents").select("lang").distinct().filter(F.col("lang").isin("fr", "en"))
    mapping = langs.select(
        F.concat(F.lit("Lang:"), F.col("lang")).alias("old"),
        F.when(F.col("lang") == "fr", "ISO:french").otherwise("Lang:fr").alias("new"),
    )
    return remap_curies(_tagged(spark, sf_dir), "text", mapping)


@registry.add(_remap_sql("CASE WHEN starts_with(t, 'S:src') THEN 'SRC:' || substr(t, 6) ELSE t END"))
def curie_remap_many(spark, sf_dir):
    """A CURIE map of thousands of entries, spread over hash buckets."""
    sources = table(spark, sf_dir, "documents").select(F.concat(F.lit("S:"), F.col("source")).alias("old")).distinct()
    listed = sources.select("old", F.concat(F.lit("SRC:"), F.substring(F.col("old"), F.lit(6), F.length("old"))).alias("new"))
    unused = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Unused:"), F.col("c_custkey").cast("string")).alias("old"), F.col("c_name").alias("new")
    )
    return remap_curies(_tagged(spark, sf_dir), "text", listed.unionAll(unused))


@registry.add(_remap_sql("CASE WHEN starts_with(t, 'S:src') THEN 'SRC:' || substr(t, 6) ELSE t END"))
def curie_remap_joined(spark, sf_dir):
    """The same remap for a map too large to travel with the plan: joined to the texts' CURIEs."""
    sources = table(spark, sf_dir, "documents").select(F.concat(F.lit("S:"), F.col("source")).alias("old")).distinct()
    mapping = sources.select("old", F.concat(F.lit("SRC:"), F.substring(F.col("old"), F.lit(6), F.length("old"))).alias("new"))
    return remap_curies(_tagged(spark, sf_dir), "text", mapping)


@registry.add("""
SELECT brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS p_type,
       coalesce(string_agg(DISTINCT size, ', ' ORDER BY size), '') AS size
FROM (SELECT nullif(p_brand, 'Brand#1') AS brand, p_type, CASE WHEN p_size > 30 THEN CAST(p_size AS VARCHAR) END AS size FROM part)
GROUP BY brand
""")
def grouped_text_join(spark, sf_dir):
    """Sorted distinct texts per group, null groups kept."""
    part = table(spark, sf_dir, "part").select(
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("brand"),
        "p_type",
        F.when(F.col("p_size") > 30, F.col("p_size")).alias("size"),
    )
    return join_distinct_text(part, ["brand"], ["p_type", "size"])


@registry.add("""
WITH t AS (SELECT user_id, CAST(hour(ts) // 6 AS INT) AS quarter, max(value) AS v FROM events GROUP BY ALL)
SELECT user_id, max(v) FILTER (quarter = 0) AS value_at_0, max(v) FILTER (quarter = 1) AS value_at_1,
       max(v) FILTER (quarter = 2) AS value_at_2, max(v) FILTER (quarter = 3) AS value_at_3
FROM t GROUP BY user_id
""")
def pivot_timepoints(spark, sf_dir):
    """One column per time point; a second row for one cell would be an error."""
    quarter = (F.hour("ts") / 6).cast("int").alias("quarter")
    cells = table(spark, sf_dir, "events").groupBy("user_id", quarter).agg(F.max("value").alias("v"))
    return pivot_unique(cells, "user_id", "quarter", "v", "value_at_{}")


@registry.add("""
SELECT l_suppkey, """ + ", ".join(
    f"round(avg({c}) FILTER (l_linenumber = {n}), 4) AS {c}_timepoint_{n}"
    for c in ("l_discount", "l_quantity") for n in range(1, 8)
) + " FROM lineitem GROUP BY l_suppkey")
def melt_pivot_mean(spark, sf_dir):
    """Mean of each measure per time point, without multiplying the rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity", "l_discount")
    means = pivot_mean(lines, "l_suppkey", "l_linenumber")
    return means.select(*[F.round(c, 4).alias(c) if "_timepoint_" in c else F.col(c) for c in means.columns])


@registry.add("SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf_dir):
    """Each row once."""
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus").distinct()


@registry.add("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def dup_keys(spark, sf_dir):
    """Keys that occur more than once."""
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@registry.add("""
SELECT DISTINCT * FROM (
  SELECT c_nationkey AS nation, c_mktsegment AS segment, NULL AS kind FROM customer
  UNION ALL SELECT s_nationkey, NULL, 'supplier' FROM supplier)
""")
def union_missing(spark, sf_dir):
    """Union by name with missing columns, each row once."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation"))
    return union_distinct([customers, suppliers])


@registry.add("""
SELECT arg_max(word, pos) AS word FROM (
  SELECT u.word AS word, doc_id * 1000000 + u.nth AS pos
  FROM documents, unnest(string_split(text, ' ')) WITH ORDINALITY AS u(word, nth))
GROUP BY lower(word)
""")
def distinct_words(spark, sf_dir):
    """Names unique without regard to case, the last spelling kept, over all words of all texts."""
    words = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("at", "word"))
    return distinct_spellings(words, "word", F.shiftleft("doc_id", 32) + F.col("at"))


@registry.add("""
SELECT p_brand, arg_max(version, [p_size, k]) AS version FROM (
  SELECT p_brand, p_size, p_partkey % 12 AS k, 'v' || p_size || '.' || (p_partkey % 12) AS version FROM part)
GROUP BY p_brand
""")
def latest_versions(spark, sf_dir):
    """Highest version per group by version order, not text order."""
    version = F.concat(F.lit("v"), F.col("p_size").cast("string"), F.lit("."), (F.col("p_partkey") % 12).cast("string"))
    return latest_version(table(spark, sf_dir, "part").select("p_brand", version.alias("version")), "version", ["p_brand"])


@registry.add("""
SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS event_type,
       CASE WHEN user_id % 5 < 3 THEN '' ELSE CAST(user_id AS VARCHAR) END AS user_code
FROM events
""")
def missing_words(spark, sf_dir):
    """Missing-value words nulled, then nulls written as blanks."""
    user = F.col("user_id")
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "NaN").otherwise(F.col("event_type")).alias("event_type"),
        F.when(user % 5 == 0, "N/A").when(user % 5 == 1, "None").when(user % 5 == 2, "").otherwise(user.cast("string")).alias("user_code"),
    )
    return clean.blank_nulls(clean.null_tokens(events))


@registry.add("""
WITH notes AS (
  SELECT l_suppkey AS id, l_returnflag AS timepoint, p_type AS condition_name, l_linestatus AS has, CAST(l_suppkey % 7 AS VARCHAR) AS uuid,
         'HP:' || (l_partkey % 50) AS hpo, p_brand AS hpo_label, CASE WHEN l_quantity > 45 THEN 'MONDO:' || l_linenumber END AS mondo
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
collapsed AS (
  SELECT id, timepoint, condition_name, string_agg(DISTINCT hpo, ', ' ORDER BY hpo) AS hpo,
         string_agg(DISTINCT hpo_label, ', ' ORDER BY hpo_label) AS hpo_label,
         coalesce(string_agg(DISTINCT mondo, ', ' ORDER BY mondo), '') AS mondo
  FROM notes GROUP BY id, timepoint, condition_name, has, uuid
),
dict AS (SELECT DISTINCT p_type AS variable, p_type || ' - Yes' AS text FROM part WHERE p_type <> 'SMALL'),
ages AS (SELECT s_suppkey AS id, s_nationkey AS a1, CASE WHEN s_acctbal > 0 THEN s_nationkey + 3 END AS a3 FROM supplier),
means AS (
  SELECT l_suppkey AS id,
         sum(CAST(l_quantity AS BIGINT)) FILTER (l_linenumber = 1) / count(*) FILTER (l_linenumber = 1) AS q1,
         sum(CAST(l_quantity AS BIGINT)) FILTER (l_linenumber = 2) / count(*) FILTER (l_linenumber = 2) AS q2,
         sum(CAST(l_quantity AS BIGINT)) FILTER (l_linenumber = 3) / count(*) FILTER (l_linenumber = 3) AS q3,
         sum(CAST(l_quantity AS BIGINT)) FILTER (l_linenumber = 4) / count(*) FILTER (l_linenumber = 4) AS q4,
         sum(CAST(l_quantity AS BIGINT)) FILTER (l_linenumber = 5) / count(*) FILTER (l_linenumber = 5) AS q5,
         sum(CAST(l_quantity AS BIGINT)) FILTER (l_linenumber = 6) / count(*) FILTER (l_linenumber = 6) AS q6,
         sum(CAST(l_quantity AS BIGINT)) FILTER (l_linenumber = 7) / count(*) FILTER (l_linenumber = 7) AS q7
  FROM lineitem GROUP BY l_suppkey
)
SELECT CAST(id AS VARCHAR) AS id, timepoint, condition_name, hpo AS hpo_result_curie, hpo_label AS hpo_result_label,
       mondo AS mondo_result_curie, '' AS mondo_result_label, coalesce(text, '') AS "conditionMeasureSourceText",
       coalesce(CAST(a1 AS VARCHAR), '') AS age_at_timepoint_1, coalesce(CAST(a3 AS VARCHAR), '') AS age_at_timepoint_3,
       q1 AS above_timepoint_1, q2 AS above_timepoint_2, q3 AS above_timepoint_3, q4 AS above_timepoint_4, q5 AS above_timepoint_5, q6 AS above_timepoint_6, q7 AS above_timepoint_7
FROM collapsed LEFT JOIN dict ON condition_name = variable LEFT JOIN ages USING (id) LEFT JOIN means USING (id)
""")
def condition_rows(spark, sf_dir):
    """Annotations collapsed per condition, with source texts, ages and measures per time point."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    suppliers = table(spark, sf_dir, "supplier")
    nothing = F.lit(None).cast("string")
    notes = lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.col("l_suppkey").alias("id"),
        F.col("l_returnflag").alias("timepoint"),
        F.col("p_type").alias("condition_name"),
        F.col("l_linestatus").alias("has_condition"),
        (F.col("l_suppkey") % 7).cast("string").alias("UUID"),
        F.concat(F.lit("HP:"), (F.col("l_partkey") % 50).cast("string")).alias("hpo_result_curie"),
        F.col("p_brand").alias("hpo_result_label"),
        F.when(F.col("l_quantity") > 45, F.concat(F.lit("MONDO:"), F.col("l_linenumber").cast("string"))).alias("mondo_result_curie"),
        *[nothing.alias(c) for c in COLLAPSED if c not in ("hpo_result_curie", "hpo_result_label", "mondo_result_curie")],
    )
    types = part.select("p_type").distinct()
    dictionary = types.select(
        F.when(F.col("p_type") == "SMALL", "timepoint").otherwise(F.col("p_type")).alias("variable"),
        F.concat(F.col("p_type"), F.lit(" (type) (x)")).alias("description"),
    )
    ages = suppliers.select(F.col("s_suppkey").alias("id"), F.lit(1).alias("timepoint"), F.col("s_nationkey").alias("age_at_visit")).unionAll(
        suppliers.filter("s_acctbal > 0").select("s_suppkey", F.lit(3), F.col("s_nationkey") + 3)
    )
    measures = lines.select(F.col("l_suppkey").alias("id"), F.col("l_linenumber").alias("timepoint"), F.col("l_quantity").alias("above"))
    wide = condition_table(notes, dictionary, ages, measures)
    means = [c for c in wide.columns if c.startswith("above_timepoint_")]
    return wide.withColumns({c: F.col(c).try_cast("double") for c in means})
