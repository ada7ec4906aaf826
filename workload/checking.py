"""Profiles, validation, scans and sinks over the given tables."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.errors import DataError
from slotweave.functions.local import local_frame
from slotweave.operators.profile import InferenceOptions, distinct_ratio, infer_table, key_columns, profile_columns
from slotweave.operators.validate import gate, summary, verdicts, violation_counts, violations
from slotweave.plans.pipeline import Options, run_pipeline
from slotweave.plans.schema import parse_schema
from slotweave.sinks.flatten import flatten
from slotweave.sinks.spec_files import write_spec_files
from slotweave.sinks.writers import drop_columns, json_lines, write_quoted_csv, yaml_documents
from slotweave.sources.archive import is_data_line, prune_files, read_archive, referenced_tables, split_lines
from slotweave.sources.catalog import Catalog
from slotweave.sources.columns import column_catalogue_of_files, tables_of_references
from slotweave.sources.delimited import discover, load_exports, read_table
from slotweave.sources.digests import data_dictionary_of_texts, pair_digests
from workload.common import Registry, scratch, table

registry = Registry()

# --- profile ---------------------------------------------------------------


def _profile_sql(name: str, columns: list[tuple[str, str]]) -> str:
    rows = []
    for i, (column, kind) in enumerate(columns):
        text = f"CAST({column} AS VARCHAR)"
        rows.append(f"""
        SELECT {i} AS position, '{column}' AS "column", count(*) AS n_rows, count({column}) AS n_present,
               CAST(min(length({text})) AS INT) AS min_length, CAST(max(length({text})) AS INT) AS max_length,
               max({text}) AS example, {kind} AS type, count(DISTINCT {column}) AS n_distinct,
               count(DISTINCT {column}) / count(*) AS ratio FROM {name}""")
    return " UNION ALL ".join(rows)


TYPED = r"""CASE WHEN count({c}) = 0 THEN 'string' WHEN bool_and(regexp_matches({c}, '^[-+]?[0-9]+$')) THEN 'integer'
  WHEN bool_and(regexp_matches({c}, '^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$')) THEN 'float'
  WHEN bool_and(regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')) THEN 'date'
  WHEN bool_and(regexp_matches({c}, '^[-+]?[0-9]+(\.[0-9]+)? [A-Za-z%/\[\]{{}}]+$')) THEN 'measurement' ELSE 'string' END"""

TEXT_SQL = """
WITH t AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) || '.5' AS amount,
                  strftime(o_orderdate, '%Y-%m-%d') AS day, o_custkey || ' mg' AS dose, o_orderpriority AS priority,
                  CASE WHEN o_orderstatus = 'O' THEN o_orderstatus END AS status, CAST(NULL AS VARCHAR) AS nothing FROM orders)
"""
TEXT_COLUMNS = ("id", "amount", "day", "dose", "priority", "status", "nothing")


def _order_text(spark, sf_dir):
    """Orders as a text table."""
    customer = F.col("o_custkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(customer, F.lit(".5")).alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.concat(customer, F.lit(" mg")).alias("dose"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderstatus")).alias("status"),
        F.lit(None).cast("string").alias("nothing"),
    )


@registry.add(TEXT_SQL + _profile_sql("t", [(c, TYPED.format(c=c)) for c in TEXT_COLUMNS]))
def profile_text_columns(spark, sf_dir):
    """Counts, lengths, examples, inferred types and exact distinct counts of a text table."""
    return distinct_ratio(profile_columns(_order_text(spark, sf_dir), exact=True))


@registry.add("""
SELECT position, "column", CASE WHEN position = min(position) OVER () THEN 'identifier' ELSE 'unique_key' END AS role
FROM (
  SELECT 1 AS position, 'c_custkey' AS "column", count(*) = count(DISTINCT c_custkey) AS u FROM customer
  UNION ALL SELECT 2, 'c_name', count(*) = count(DISTINCT c_name) FROM customer
  UNION ALL SELECT 3, 'c_acctbal', count(*) = count(DISTINCT c_acctbal) FROM customer
  UNION ALL SELECT 0, 'c_nationkey', count(*) = count(DISTINCT c_nationkey) FROM customer
) WHERE u
""")
def unique_keys(spark, sf_dir):
    """Identifier and further unique columns of a table."""
    customer = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_name", "c_acctbal")
    return key_columns(customer, slice_values=200)


# --- validation ------------------------------------------------------------

ORDER_SCHEMA = """
enums:
  state: {permissible_values: {O: {}, F: {}}}
classes:
  orders:
    attributes:
      id: {identifier: true, range: integer}
      amount: {range: integer}
      day: {range: date}
      dose: {range: float}
      priority: {range: state}
      status: {range: state, required: true}
      absent: {required: true}
      customer: {identifier: true}
  customer:
    attributes:
      c_custkey: {identifier: true, range: integer}
      c_name: {required: true}
      c_mktsegment: {range: string}
      c_acctbal: {range: float}
      c_nationkey: {range: integer}
"""


def _order_violations(spark, sf_dir):
    rows = _order_text(spark, sf_dir)
    customer = F.regexp_replace("dose", " mg", "").alias("customer")
    return violations(rows.select("*", customer), "orders", parse_schema(ORDER_SCHEMA))


VIOLATION_SQL = TEXT_SQL + """
, u AS (SELECT *, replace(dose, ' mg', '') AS customer FROM t),
v AS (
  SELECT 'amount' AS slot, 'type' AS rule, amount AS value FROM u
  UNION ALL SELECT 'dose', 'type', dose FROM u
  UNION ALL SELECT 'priority', 'enum', priority FROM u
  UNION ALL SELECT 'status', 'required', NULL FROM u WHERE status IS NULL
  UNION ALL SELECT 'absent', 'missing column', NULL
  UNION ALL SELECT 'nothing', 'unknown column', NULL
  UNION ALL SELECT 'customer', 'duplicate', customer FROM u GROUP BY customer HAVING count(*) > 1
)
"""


@registry.add(VIOLATION_SQL + """SELECT 'orders' AS "table", slot, rule, value FROM v""")
def validate_rows(spark, sf_dir):
    """Every broken rule: type, enum, required, unknown and missing columns, duplicate identifiers."""
    return _order_violations(spark, sf_dir)


@registry.add(VIOLATION_SQL + """SELECT 'orders' AS "table", slot, rule, count(*) AS n FROM v GROUP BY slot, rule""")
def validate_counts(spark, sf_dir):
    """Violations counted per slot and rule."""
    return violation_counts(_order_violations(spark, sf_dir))


SUMMARY_SQL = VIOLATION_SQL + """,
c AS (
  SELECT 'customer' AS t, count(*) FILTER (WHERE c_custkey IS NULL OR c_name IS NULL OR trim(c_name) = '') + count(c_custkey) - count(DISTINCT c_custkey) AS n FROM customer
  UNION ALL SELECT 'orders', count(*) FROM v
)
SELECT count(*) AS n_tables, count(*) FILTER (WHERE n > 0) AS n_failing, coalesce(string_agg(t, ', ' ORDER BY t) FILTER (WHERE n > 0), '') AS failing
FROM c
"""


def _verdicts(spark, sf_dir):
    good = violations(table(spark, sf_dir, "customer"), "customer", parse_schema(ORDER_SCHEMA))
    return verdicts(violation_counts(good.unionAll(_order_violations(spark, sf_dir))), ["customer", "orders"])


@registry.add(SUMMARY_SQL)
def validate_summary(spark, sf_dir):
    """How many tables fail validation, and which."""
    return summary(_verdicts(spark, sf_dir))


@registry.add(f"""
WITH s AS ({SUMMARY_SQL})
SELECT mode, n_failing = 0 AS passed,
       CASE WHEN mode = 'strict' AND n_failing > 0 THEN n_failing || ' of ' || n_tables || ' tables fail validation: ' || failing END AS message
FROM s, (VALUES ('strict'), ('lenient')) m(mode)
""")
def validate_gate(spark, sf_dir):
    """The gate after validation: a strict run ends with the tables that fail, a lenient one goes on."""
    verdict = _verdicts(spark, sf_dir)
    rows = [("lenient", str(gate(verdict, strict=False)), None)]
    try:
        rows.append(("strict", str(gate(verdict, strict=True)), None))
    except DataError as e:
        rows.append(("strict", "False", str(e)))
    told = local_frame(spark, rows, "mode string, passed string, message string")
    return told.withColumn("passed", F.col("passed").cast("boolean"))


@registry.add(TEXT_SQL + "SELECT DISTINCT 'priority_enum' AS enum, priority AS value FROM t UNION ALL "
              "SELECT DISTINCT 'status_enum', status FROM t WHERE status IS NOT NULL")
def inferred_enums(spark, sf_dir):
    """The enums inferred for text columns of few values, with their values."""
    _, enums, _ = infer_table(_order_text(spark, sf_dir), InferenceOptions(max_enum_size=10))
    return local_frame(spark, [(e, v) for e, values in enums.items() for v in values], "enum string, value string")


# A wide text table: keys, almost keys, enums and what is neither.
WIDE = {
    "order": "o_orderkey",
    "customer": "o_custkey",
    "status": "o_orderstatus",
    "priority": "o_orderpriority",
    "pair": "o_custkey || '-' || o_orderstatus",
    "almost": "'n' || CASE WHEN o_orderkey % 1000 = 0 THEN 0 ELSE o_orderkey END",
    "back": "'k' || (900000000 - o_orderkey)",
    "gaps": "CASE WHEN o_orderkey % 2 = 0 THEN 'v' || o_orderkey END",
    "both": "o_orderstatus || CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END",
    "sparse": "CASE WHEN o_custkey % 7 = 0 THEN 'x' || o_custkey % 3 END",
}


@registry.add(
    "WITH w AS (SELECT "
    + ", ".join(f'CAST({e} AS VARCHAR) AS "{c}"' for c, e in WIDE.items())
    + " FROM orders) SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CASE WHEN count("{c}") = count(*) AND count(DISTINCT "{c}") = count(*) THEN 'key'
            WHEN count(DISTINCT "{c}") <= 5 AND NOT bool_and(regexp_matches("{c}", '^[0-9]+$')) THEN 'enum' END AS role,
            CASE WHEN count(DISTINCT "{c}") <= 5 AND NOT bool_and(regexp_matches("{c}", '^[0-9]+$'))
            THEN string_agg(DISTINCT "{c}", ',' ORDER BY "{c}") END AS codes FROM w"""
        for c in WIDE
    )
    + ") WHERE role IS NOT NULL"
)
def inferred_roles(spark, sf_dir):
    """Keys and enums of a wide text table: most columns are disproved by a slice of their values."""
    wide = table(spark, sf_dir, "orders").selectExpr(*[f"cast({e} AS string) AS `{c}`" for c, e in WIDE.items()])
    slots, enums, keys = infer_table(wide, InferenceOptions(max_enum_size=5))
    unique = [s.name for s in slots.values() if s.identifier] + list(keys)
    rows = [(c, "key", None) for c in unique] + [(e.removesuffix("_enum"), "enum", ",".join(vs)) for e, vs in enums.items()]
    return local_frame(spark, rows, "column string, role string, codes string")


# --- scans -----------------------------------------------------------------


@registry.add("""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, chr(34) || coalesce(text, '') || chr(10) || lang || ',' || chr(34) AS text FROM documents
""")
def quoted_csv_round_trip(spark, sf_dir):
    """Cells with quotes, separators and line breaks, written as quoted CSV and read back."""
    quote = F.lit('"')
    text = F.concat(quote, F.coalesce("text", F.lit("")), F.lit("\n"), F.col("lang"), F.lit(","), quote)
    path = scratch(spark, "quoted-csv")
    write_quoted_csv(table(spark, sf_dir, "documents").select("doc_id", text.alias("text")), path)
    return read_table(spark, path, ",", breaks=True)


@registry.add("""
SELECT CAST(c_custkey AS VARCHAR) AS subject, CAST(NULL AS VARCHAR) AS phv1,
       CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS phv2, CASE WHEN c_nationkey > 5 THEN 'extra' END AS beyond
FROM customer WHERE c_nationkey >= 5
""")
def archive_lines(spark, sf_dir):
    """Archive lines of every kind: data rows kept and split, missing and blank cells null, cells beyond the header kept apart."""
    n, key = F.col("c_nationkey"), F.col("c_custkey").cast("string")
    line = (
        F.when(n == 0, F.concat(F.lit("# "), F.col("c_name")))
        .when(n == 1, F.concat(F.lit("##\tphv"), key))
        .when(n == 2, F.concat(F.lit("dbGaP_Subject_ID\t"), F.col("c_name")))
        .when(n == 3, F.lit("  \t"))
        .when(n == 4, F.concat(key, F.lit("\tIntentionally Blank")))
        .when(n == 5, key)
        .otherwise(F.concat(key, F.lit("\t\t"), F.col("c_mktsegment"), F.lit("\textra")))
    )
    lines = table(spark, sf_dir, "customer").select(line.alias("line"))
    return split_lines(lines.filter(is_data_line(F.col("line"))), "line", ["subject", "phv1", "phv2"], "beyond")


def _archive_files(spark, sf_dir, layout: str, keys: Column) -> list[str]:
    """A compressed file per nation of the customers chosen: head lines, then rows; returns the paths."""
    nation, key = F.col("c_nationkey"), F.col("c_custkey").cast("string")
    more = F.when(nation % 3 == 0, F.lit("\tphv00000003.v2.p1")).otherwise("")
    accessions = F.concat(F.lit("##\tphv00000001.v1.p1.c1\tphv00000002.v1"), more)
    heads = ["# a comment", "# another", "", accessions, "dbGaP_Subject_ID\tNAME\tSEGMENT"]
    cells = F.concat(key, F.lit("\t"), "c_name", F.lit("\t"), F.when(nation % 2 == 0, F.col("c_mktsegment")).otherwise(""))
    third = F.when((nation % 3 == 0) & (F.col("c_custkey") % 4 > 0), F.lit("\tthird")).otherwise("")
    beyond = F.when((nation % 3 > 0) & (F.col("c_custkey") % 5 == 0), F.concat(F.lit("\t\t"), key)).otherwise("")
    rows = table(spark, sf_dir, "customer").where(keys)
    first = [F.struct(F.lit(float(i - 9)).alias("at"), (F.lit(h) if isinstance(h, str) else h).alias("value")) for i, h in enumerate(heads)]
    lines = rows.select(nation, F.struct(F.col("c_custkey").cast("double").alias("at"), F.concat(cells, third, beyond).alias("value")).alias("l"))
    tops = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey")).where(keys).select(nation, F.explode(F.array(*first)).alias("l"))
    placed = tops.unionAll(lines).select(nation, "l.at", "l.value").repartition(8, nation).sortWithinPartitions(nation, "at")
    path = scratch(spark, f"archives-{layout}")
    placed.select("value", nation).write.partitionBy("c_nationkey").option("compression", "gzip").text(path)
    return spark.read.text(path).inputFiles()


@registry.add("""
SELECT CAST(c_custkey AS VARCHAR) AS subject, c_name AS name, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END AS segment,
       CASE WHEN c_nationkey % 3 = 0 AND c_custkey % 4 > 0 THEN 'third' END AS third,
       CASE WHEN c_nationkey % 3 > 0 AND c_custkey % 5 = 0 THEN chr(9) || c_custkey END AS beyond
FROM customer
""")
def archive_files(spark, sf_dir):
    """Compressed archives of both layouts, written and read: headers found by a task a file, longer rows kept apart."""
    frames = []
    for layout, keys in (("markers", F.col("c_nationkey") < 12), ("blank", F.col("c_nationkey") >= 12)):
        read = read_archive(spark, _archive_files(spark, sf_dir, layout, keys), layout)
        names = [F.col("dbGaP_Subject_ID").alias("subject"), F.col("phv00000001").alias("name"), F.col("phv00000002").alias("segment")]
        frames.append(read.select(*names, F.col("phv00000003").alias("third"), F.col("_beyond_header").alias("beyond")))
    return frames[0].unionAll(frames[1])


def _delimited_files(spark, sf_dir) -> str:
    """A comma- or tab-separated file per nation with its customers; the folder."""
    n, key = F.col("c_nationkey"), F.lpad(F.col("c_custkey").cast("string"), 12, "0")
    root = scratch(spark, "delimited")
    for kind, sep, odd in (("csv", ",", 0), ("tsv", "\t", 1)):
        note = F.concat(F.lit('"'), "c_mktsegment", F.lit(f'{sep} ""x""')) if kind == "csv" else F.col("c_mktsegment")
        cells = F.concat_ws(sep, "c_name", F.concat(note, F.lit('"')) if kind == "csv" else note, F.when(n % 3 == 0, "t").otherwise(""))
        rows = table(spark, sf_dir, "customer").select(n, key.alias("phv"), F.concat(cells, F.lit("\n")).alias("text"))
        head = F.concat(F.lit(sep.join(("name", "note", "third"))), F.lit("\n"))
        heads = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.lit("").alias("phv"), head.alias("text"))
        named = rows.unionAll(heads).where(n % 2 == odd).select(
            F.lit(kind).alias("cohort"), F.concat(F.lit("People-"), n.cast("string")).alias("varname"), "phv", "text"
        )
        write_spec_files(named, f"{root}/{kind}", "{cohort}/{varname}", suffix=f".{kind}")
    return root


@registry.add("""
SELECT 'people_' || c_nationkey AS "table", c_name AS name,
       CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment || ', "x"' WHEN c_mktsegment = 'BUILDING' THEN 'B' || c_nationkey ELSE c_mktsegment END AS note,
       CASE WHEN c_nationkey % 3 = 0 THEN 't' WHEN c_nationkey = 4 THEN 'none' END AS third
FROM customer
""")
def delimited_files(spark, sf_dir):
    """Delimited files discovered below a folder, their separators found in one job, cells replaced by file and column."""
    paths = discover(spark, _delimited_files(spark, sf_dir))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("n"))
    rule = lambda column, old, new: [F.lit(column).alias("column_name"), F.lit(old).alias("original_value"), new.alias("replacement_value")]
    rules = nation.select(F.concat(F.lit("People-"), "n", F.lit(".tsv")).alias("filename"), *rule("note", "BUILDING", F.concat(F.lit("B"), "n")))
    more = nation.where("n = '4'").select(F.concat(F.lit("People-"), "n", F.lit(".csv")).alias("filename"), *rule("third", "", F.lit("none")))
    catalog = Catalog.delimited(spark, paths, replacements=rules.unionAll(more))
    return reduce(DataFrame.unionAll, [df.select(F.lit(t).alias("table"), "name", "note", "third") for t, df in catalog.items()])


RUN_SPEC = """- class_derivations:
    Account:
      populated_from: customer
      slot_derivations:
        id: {populated_from: c_custkey}
        label: {populated_from: c_name}
        cents: {expr: '{c_acctbal} * 100'}
        share: {expr: '100 / {c_nationkey}'}
"""
RUN_SCHEMA = "classes: {Account: {attributes: {id: {range: integer}, label: {range: string}, cents: {range: float}, share: {range: float}}}}\n"
RUN_FORMATS = ("jsonl", "json", "tsv", "yaml")


def _full_run(spark, sf_dir):
    root = scratch(spark, "run")
    texts = [("specs", "account", "", RUN_SPEC), ("schema", "target", "", RUN_SCHEMA)]
    write_spec_files(local_frame(spark, texts, "cohort string, varname string, phv string, text string"), root, "{cohort}/{varname}")
    tables = Catalog.of(spark, {"customer": table(spark, sf_dir, "customer"), "region": table(spark, sf_dir, "region")})
    return run_pipeline(spark, f"{root}/specs", f"{root}/schema/target.yaml", f"{root}/out", tables=tables, options=Options(formats=RUN_FORMATS))


@registry.add("""
SELECT f AS format, c_custkey AS id, c_name AS label, c_acctbal * 100.0::DOUBLE AS cents, 100.0::DOUBLE / c_nationkey AS share
FROM customer, (VALUES ('jsonl'), ('json'), ('tsv'), ('yaml')) v(f) WHERE c_nationkey <> 0
""")
def run_outputs(spark, sf_dir):
    """The whole run, its records written in four formats and read back."""
    paths = dict(zip(RUN_FORMATS, _full_run(spark, sf_dir).outputs["Account"]))
    ddl = "id bigint, label string, cents double, share double"
    lines = spark.read.text(paths["jsonl"]).select(F.lit("jsonl").alias("format"), F.from_json("value", ddl).alias("r"))
    body = F.regexp_replace("value", "^,", "")
    wrapped = spark.read.text(paths["json"]).where(body.startswith('{"id"')).select(F.lit("json").alias("format"), F.from_json(body, ddl).alias("r"))
    cells = spark.read.schema(ddl).csv(paths["tsv"], sep="\t", header=True).select(F.lit("tsv").alias("format"), F.struct("*").alias("r"))
    documents = spark.read.option("lineSep", "---\n").text(paths["yaml"]).where("trim(value) <> ''")
    field = lambda name: F.regexp_extract("value", f'(?m)^{name}: "?([^"\\n]*)"?$', 1)
    record = F.struct(*[field(c.name).cast(c.dataType).alias(c.name) for c in T._parse_datatype_string(ddl).fields])
    return reduce(DataFrame.unionAll, [lines, wrapped, cells, documents.select(F.lit("yaml").alias("format"), record.alias("r"))]).select("format", "r.*")


@registry.add("""
SELECT 'Account' AS entity, 'customer' AS "table", 'share' AS slot, 'division by zero' AS message, count(*) AS n
FROM customer WHERE c_nationkey = 0 HAVING count(*) > 0
""")
def run_errors(spark, sf_dir):
    """The errors that the whole run counts while it writes."""
    return _full_run(spark, sf_dir).errors


@registry.add("""
SELECT 'phs0.pht' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '.v1.txt.gz' AS path,
       'pht' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS table_id
FROM customer WHERE c_custkey IN (
  SELECT CASE o_orderstatus WHEN 'P' THEN o_custkey ELSE 0 END FROM orders
  UNION SELECT CASE o_orderstatus WHEN 'P' THEN o_custkey // 2 ELSE 0 END FROM orders)
""")
def spec_pruning(spark, sf_dir):
    """Files whose table some spec text mentions."""
    customer = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    files = table(spark, sf_dir, "customer").select(F.concat(F.lit("phs0.pht"), customer, F.lit(".v1.txt.gz")).alias("path"))
    unnamed = table(spark, sf_dir, "supplier").select(F.concat(F.col("s_name"), F.lit(".txt.gz")).alias("path"))
    # The texts of other orders name tables that no file holds.
    key = F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).otherwise(0)
    first = F.lpad(key.cast("string"), 6, "0")
    half = F.lpad(F.floor(key / 2).cast("string"), 6, "0")
    texts = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("populated_from: pht"), first, F.lit("\nexpr: '{pht"), half, F.lit(".phv1}'")).alias("value")
    )
    return prune_files(files.unionAll(unnamed), referenced_tables(texts))


@registry.add("""
SELECT 'phv' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS "column", max('pht' || c_nationkey) AS "table"
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1
""")
def column_lookup(spark, sf_dir):
    """The table that holds each accession a text mentions."""
    name = F.concat(F.lit("phv"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
    catalogue = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("pht"), F.col("c_nationkey").cast("string")).alias("table"), name.alias("column")
    )
    texts = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("expr: '{phv"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lit("} * 365'")).alias("value")
    )
    return tables_of_references(texts, catalogue)


@registry.add("""
SELECT 'phv' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS "column", max('pht_' || c_nationkey) AS "table"
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1
UNION ALL SELECT column_name, 'customer' FROM (DESCRIBE customer)
UNION ALL SELECT column_name, 'orders' FROM (DESCRIBE orders)
""")
def file_columns(spark, sf_dir):
    """Accessions looked up in the headers of many written files, and the columns of stored tables, from one job."""
    n, key = F.col("c_nationkey"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    separator = F.when(n % 2 == 0, "\t").otherwise(",")
    cells = table(spark, sf_dir, "customer").select(n, key.alias("phv"), F.concat(separator, F.lit("phv"), key).alias("text"))
    ends = [F.struct(F.lit(phv).alias("phv"), F.lit(text).alias("text")) for phv, text in (("", "subject"), ("~", "\n1\n"))]
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.explode(F.array(*ends)).alias("e"))
    named = cells.unionAll(nation.select(n, "e.phv", "e.text"))
    root = scratch(spark, "headers")
    write_spec_files(
        named.select(F.lit("tables").alias("cohort"), F.concat(F.lit("pht-"), n.cast("string")).alias("varname"), "phv", "text"),
        root, "{cohort}/{varname}", suffix=".csv",
    )
    catalogue = column_catalogue_of_files(spark, [*discover(spark, root), f"{sf_dir}/customer.parquet", f"{sf_dir}/orders.parquet"])
    texts = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("expr: '{phv"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lit("} * 365'")).alias("value")
    )
    return tables_of_references(texts, catalogue).unionByName(catalogue.where("table in ('customer', 'orders')"))


@registry.add("""
SELECT DISTINCT trim(c_mktsegment) AS cohort, c_name AS name, NULL AS nation FROM customer WHERE c_custkey % 2 = 0
UNION SELECT NULL, s_name, CAST(s_nationkey AS VARCHAR) FROM supplier
""")
def exports_combined(spark, sf_dir):
    """Metadata exports of several sheets: the wanted sheet of each, cleaned, united, repeated rows once."""
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    padded = F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("cohort")
    sheet = customer.select(padded, F.col("c_name").alias("name"), F.lit(None).cast("string").alias("nothing")).where("c_custkey % 2 = 0")
    other = customer.select(padded, F.lit("not wanted").alias("name"))
    plain = supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("nation"))
    exports = [{"notes": other, "second": other, "wanted": sheet}, {"any": plain, "later": other}, {"second": sheet}]
    return load_exports(exports, known=("wanted", "second"))


def _digests(spark, sf_dir):
    dictionaries = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("/d/phs1.v7.pht"), F.col("c_custkey").cast("string"), F.lit(".v6.T.data_dict.xml")).alias("path")
    )
    reports = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("/r/phs1.v7.pht"), F.col("s_suppkey").cast("string"), F.lit(".v6.p2.T.var_report.xml")).alias("path")
    )
    return pair_digests(dictionaries, reports)


@registry.add("""
SELECT 'phs1.v7.pht' || c_custkey || '.v6.T' AS digest, '/d/phs1.v7.pht' || c_custkey || '.v6.T.data_dict.xml' AS data_dict,
       '/r/phs1.v7.pht' || s_suppkey || '.v6.p2.T.var_report.xml' AS var_report
FROM customer JOIN supplier ON c_custkey = s_suppkey
""")
def digest_pairs(spark, sf_dir):
    """Data dictionaries paired with variable reports by file identity."""
    return _digests(spark, sf_dir)[0]


@registry.add("""
SELECT 'phs1.v7.pht' || c_custkey || '.v6.T' AS digest, '/d/phs1.v7.pht' || c_custkey || '.v6.T.data_dict.xml' AS data_dict
FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
""")
def digest_unmatched(spark, sf_dir):
    """Data dictionaries without a report."""
    return _digests(spark, sf_dir)[1]


@registry.add("""
WITH paired AS (SELECT * FROM customer JOIN supplier ON c_custkey = s_suppkey),
v AS (
  SELECT c_custkey, 1 AS i, 'SEX' AS name, c_mktsegment AS description, 'encoded' AS type, NULL AS unit,
         '1=Male;2=Female;Other=Other' AS codes FROM paired
  UNION ALL SELECT c_custkey, 2, c_name, NULL, CASE WHEN c_custkey % 2 = 0 THEN 'num' ELSE 'decimal' END,
         CASE WHEN c_custkey % 4 = 0 THEN 'm' ELSE 'cm' END, NULL FROM paired
  UNION ALL SELECT c_custkey, 3, 'C & "D"', 'a < b', CASE WHEN c_custkey % 3 = 0 THEN 'string' END, NULL, 'x=X' FROM paired
)
SELECT 'pht' || c_custkey AS "table", 'phv' || lpad(CAST(c_custkey * 10 + i AS VARCHAR), 8, '0') AS variable,
       name, description, type, unit, codes
FROM v
""")
def digest_variables(spark, sf_dir):
    """Variables of XML digests: code lists with repeated and missing codes; types and units of reports win."""
    key = F.col("c_custkey")
    phv = lambda i: F.concat(F.lit('<variable id="phv'), F.lpad((key * 10 + i).cast("string"), 8, "0"), F.lit('.v1.p1">'))
    path = lambda end: F.concat(F.lit("/d/phs1.v7.pht"), key.cast("string"), F.lit(end)).alias("path")
    sex = F.concat(
        phv(1), F.lit("<name>SEX</name><description>"), "c_mktsegment", F.lit("</description><type>encoded</type>"),
        F.lit('<value code="1">Male</value><value code="2">Female</value><value code="1">Again</value><value>Other</value><value/></variable>'),
    )
    size = F.concat(phv(2), F.lit("<name>"), "c_name", F.lit("</name><type>decimal</type><unit>cm</unit></variable>"))
    odd = F.concat(phv(3), F.lit('<name>C &amp; "D"</name><description>a &lt; b</description><value code="x">X</value></variable>'))
    text = F.concat(F.lit("<data_table>"), sex, size, odd, F.lit("</data_table>")).alias("text")
    dictionaries = table(spark, sf_dir, "customer").select(path(".v6.T.data_dict.xml"), text)
    report = lambda i, attributes: F.concat(F.substring_index(phv(i), ">", 1), F.lit(" "), attributes, F.lit("/>"))
    num = F.when(key % 2 == 0, F.lit('calculated_type="num"')).otherwise(F.lit(""))
    metre = F.when(key % 4 == 0, F.lit(' units="m"')).otherwise(F.lit(""))
    string = F.when(key % 3 == 0, F.lit('calculated_type="string"')).otherwise(F.lit(""))
    body = F.concat(F.lit("<data_table>"), report(2, F.concat(num, metre)), report(3, string), F.lit("</data_table>")).alias("text")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"))
    found = data_dictionary_of_texts(dictionaries, suppliers.select(path(".v6.p2.T.var_report.xml"), body))
    pairs = F.transform(F.array_sort(F.map_entries("codes")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.withColumn("codes", F.nullif(F.array_join(pairs, ";"), F.lit("")))


# --- sinks -----------------------------------------------------------------


def _nested(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(F.col("c_nationkey").alias("nation"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")).alias("place"),
        ).alias("who"),
        F.array(F.struct(F.lit("a").alias("k"), F.col("c_nationkey").alias("v")), F.struct(F.lit('"q"').alias("k"), F.lit(None).cast("int").alias("v"))).alias("items"),
    )


@registry.add("""
SELECT c_custkey AS id, c_name AS who__name, c_nationkey AS who__place__nation,
       nullif(c_mktsegment, 'BUILDING') AS who__place__segment,
       '[{"k":"a","v":' || c_nationkey || '},{"k":"\\"q\\""}]' AS items
FROM customer
""")
def flatten_records(spark, sf_dir):
    """Nested records as flat columns, arrays as JSON."""
    return flatten(_nested(spark, sf_dir))


@registry.add("""
SELECT '{"id":' || c_custkey || ',"who":{"name":"' || c_name || '","place":{"nation":' || c_nationkey
       || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ',"segment":"' || c_mktsegment || '"' END
       || '}},"items":[{"k":"a","v":' || c_nationkey || '},{"k":"\\"q\\""}]}' AS value
FROM customer
""")
def json_records(spark, sf_dir):
    """One JSON text per record."""
    return json_lines(_nested(spark, sf_dir))


@registry.add("""
SELECT '---' || chr(10) || 'id: ' || c_custkey || chr(10) || 'who:' || chr(10) || '  name: "' || c_name || '"' || chr(10)
       || '  place:' || chr(10) || '    nation: ' || c_nationkey || chr(10) || '    segment: '
       || CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE '"' || c_mktsegment || '"' END || chr(10)
       || 'items:' || chr(10) || '- k: "a"' || chr(10) || '  v: ' || c_nationkey || chr(10)
       || '- k: "\\"q\\""' || chr(10) || '  v: null' AS value
FROM customer
""")
def yaml_records(spark, sf_dir):
    """One YAML document per record."""
    return yaml_documents(_nested(spark, sf_dir))


@registry.add("SELECT c_custkey, c_name FROM customer")
def keep_columns(spark, sf_dir):
    """A table without its problem columns."""
    return drop_columns(table(spark, sf_dir, "customer"), ["c_nationkey", "c_acctbal", "c_mktsegment", "not_there"])
