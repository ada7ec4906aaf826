"""Class derivations: specs compiled over the given tables."""

import json

from pyspark.sql import functions as F

from slotweave.plans.derive import Mapper
from slotweave.plans.schema import parse_schema
from slotweave.plans.spec import parse_specs
from slotweave.sinks.flatten import flatten
from slotweave.sources.catalog import Catalog
from slotweave.streaming import run_stream, stream_results
from workload.common import Registry, catalog, derive, scratch, table

registry = Registry()

BASIC_SPEC = """
- class_derivations:
    Account:
      populated_from: customer
      slot_derivations:
        id: {populated_from: c_custkey}
        label: {populated_from: c_name}
        source: {value: TOY BASELINE}
        balance_cents: {expr: '{c_acctbal} * 100'}
        net_units: {expr: '({c_acctbal} - 10) * 2 + {c_nationkey} / 4'}
        whole_balance: {expr: '{c_acctbal} * 365'}
"""
BASIC_SCHEMA = """
classes:
  Account:
    attributes:
      id: {identifier: true, range: integer}
      label:
      source:
      balance_cents: {range: float}
      net_units: {range: float}
      whole_balance: {range: integer}
"""


@registry.add("""
SELECT c_custkey AS id, c_name AS label, 'TOY BASELINE' AS source,
       c_acctbal * 100.0::DOUBLE AS balance_cents,
       (c_acctbal - 10.0::DOUBLE) * 2.0::DOUBLE + CAST(c_nationkey AS DOUBLE) / 4.0::DOUBLE AS net_units,
       CAST(trunc(c_acctbal * 365.0::DOUBLE) AS BIGINT) AS whole_balance
FROM customer
""")
def derive_basic(spark, sf_dir):
    """Copies, a constant, arithmetic, integer coercion."""
    return derive(spark, sf_dir, "Account", BASIC_SPEC, BASIC_SCHEMA).records


REGISTERED_SPEC = """
- class_derivations:
    Account:
      populated_from: customer
      slot_derivations:
        id: {populated_from: c_custkey}
        code: {expr: 'initials({c_mktsegment}, 3) + "-" + shout({c_name})'}
        cents: {expr: 'cents({c_acctbal})'}
"""
REGISTERED_SCHEMA = """
classes: {Account: {attributes: {id: {range: integer}, code: {range: string}, cents: {range: integer}}}}
"""


@registry.add("""
SELECT c_custkey AS id, lower(substr(c_mktsegment, 1, 3)) || '-' || upper(c_name) AS code, CAST(round(c_acctbal * 100) AS BIGINT) AS cents
FROM customer
""")
def derive_registered(spark, sf_dir):
    """Functions registered by the user, called in slot expressions."""
    mapper = Mapper(catalog(spark, sf_dir), parse_specs([REGISTERED_SPEC]), parse_schema(REGISTERED_SCHEMA))
    mapper.register_function("shout", F.upper)
    mapper.register_function("initials", lambda text, n: F.lower(F.substring(text, F.lit(1), n.cast("int"))))
    mapper.register_function("cents", lambda amount: F.round(amount * 100))
    return mapper.derive("Account").records


VALUE_MAP_SPEC = """
- class_derivations:
    OrderState:
      populated_from: orders
      slot_derivations:
        order: {populated_from: o_orderkey}
        state:
          populated_from: o_orderstatus
          value_mappings: {'O': 'OMOP:1001', 'F': 'OMOP:1002'}
        urgency:
          populated_from: o_orderpriority
          value_mappings: {'1-URGENT': '0', '2-HIGH': '50', '5-LOW': None}
"""


@registry.add("""
SELECT o_orderkey AS "order",
       CASE o_orderstatus WHEN 'O' THEN 'OMOP:1001' WHEN 'F' THEN 'OMOP:1002' END AS state,
       CASE o_orderpriority WHEN '1-URGENT' THEN '0' WHEN '2-HIGH' THEN '50' WHEN '5-LOW' THEN 'None' END AS urgency
FROM orders
""")
def derive_value_map(spark, sf_dir):
    """Value mappings; unlisted codes become null, ``None`` is text."""
    return derive(spark, sf_dir, "OrderState", VALUE_MAP_SPEC).records


ENUM_SPEC = """
- class_derivations:
    Shipment:
      populated_from: lineitem
      slot_derivations:
        order: {populated_from: l_orderkey}
        line: {populated_from: l_linenumber}
        flag: {populated_from: l_returnflag}
        status: {populated_from: l_linestatus}
  enum_derivations:
    flag_enum:
      mirror_source: false
      permissible_value_derivations:
        RETURNED: {populated_from: R}
        ACCEPTED: {populated_from: A}
    status_enum:
      mirror_source: true
      permissible_value_derivations:
        OPEN: {populated_from: O}
"""
ENUM_SCHEMA = """
enums:
  flag_enum: {permissible_values: {RETURNED: {}, ACCEPTED: {}}}
  status_enum: {permissible_values: {OPEN: {}, F: {}}}
classes:
  Shipment:
    attributes:
      order: {range: integer}
      line: {range: integer}
      flag: {range: flag_enum}
      status: {range: status_enum}
"""


@registry.add("""
SELECT l_orderkey AS "order", CAST(l_linenumber AS BIGINT) AS line,
       CASE l_returnflag WHEN 'R' THEN 'RETURNED' WHEN 'A' THEN 'ACCEPTED' END AS flag,
       CASE l_linestatus WHEN 'O' THEN 'OPEN' ELSE l_linestatus END AS status
FROM lineitem
""")
def derive_enum(spark, sf_dir):
    """Enum derivations through the range of the slot, with and without mirroring."""
    return derive(spark, sf_dir, "Shipment", ENUM_SPEC, ENUM_SCHEMA).records


#: Codes 0 to 49 999 and their values; every seventh code is not listed.
LARGE_CODES = {str(k): f"OMOP:{k * 37 % 50_000}" for k in range(50_000) if k % 7}
LARGE_SPEC = {
    "class_derivations": {
        "CodedLine": {
            "populated_from": "lineitem",
            "slot_derivations": {
                "line": {"expr": "l_orderkey * 10 + l_linenumber", "range": "integer"},
                "part": {"populated_from": "l_partkey", "value_mappings": LARGE_CODES},
                "order": {"populated_from": "l_orderkey", "value_mappings": LARGE_CODES},
                "kind": {"populated_from": "l_suppkey"},
            },
        }
    },
    "enum_derivations": {
        "kind_enum": {
            "mirror_source": True,
            "permissible_value_derivations": {f"K{k}": {"populated_from": str(k)} for k in range(0, 20_000, 2)},
        }
    },
}
LARGE_SCHEMA = "enums: {kind_enum: {permissible_values: {K0: {}}}}\nclasses: {CodedLine: {attributes: {line: {range: integer}, kind: {range: kind_enum}}}}"
LARGE_SQL = "CASE WHEN {c} % 7 <> 0 AND {c} < 50000 THEN 'OMOP:' || {c} * 37 % 50000 END"


@registry.add(f"""
SELECT l_orderkey * 10 + l_linenumber AS line, {LARGE_SQL.format(c="l_partkey")} AS part, {LARGE_SQL.format(c="l_orderkey")} AS "order",
       CASE WHEN l_suppkey % 2 = 0 AND l_suppkey < 20000 THEN 'K' ELSE '' END || l_suppkey AS kind
FROM lineitem
""")
def derive_large_maps(spark, sf_dir):
    """Two slots with a map of 43 000 codes and an enum of 10 000, from one dictionary."""
    return derive(spark, sf_dir, "CodedLine", json.dumps(LARGE_SPEC), LARGE_SCHEMA).records



CASE_SPEC = """
- class_derivations:
    Visit:
      populated_from: lineitem
      slot_derivations:
        order: {populated_from: l_orderkey}
        line: {populated_from: l_linenumber}
        visit:
          expr: 'case(({l_linenumber} == 1, "VISIT 1"), ({l_linenumber} == 2, "VISIT 2"), ({l_returnflag} == "R", "RETURN"))'
        band:
          expr: '"big" if {l_quantity} >= 40 else "mid" if {l_quantity} > 10 and {l_linestatus} != "O" else "small"'
        dose:
          expr: 'case(({l_returnflag} == "A", {l_quantity} * 2.54), ({l_returnflag} == "N", {l_quantity}))'
"""


@registry.add("""
SELECT l_orderkey AS "order", l_linenumber AS line,
       CASE WHEN l_linenumber = 1 THEN 'VISIT 1' WHEN l_linenumber = 2 THEN 'VISIT 2'
            WHEN l_returnflag = 'R' THEN 'RETURN' END AS visit,
       CASE WHEN l_quantity >= 40 THEN 'big' WHEN l_quantity > 10 AND l_linestatus <> 'O' THEN 'mid'
            ELSE 'small' END AS band,
       CASE WHEN l_returnflag = 'A' THEN l_quantity * 2.54::DOUBLE WHEN l_returnflag = 'N' THEN l_quantity END AS dose
FROM lineitem
""")
def derive_case(spark, sf_dir):
    """case(), chained conditionals, comparisons with text and numbers."""
    return derive(spark, sf_dir, "Visit", CASE_SPEC).records


CONCAT_SPEC = """
- class_derivations:
    Place:
      populated_from: nation
      joins:
        region: {join_on: r_regionkey}
      slot_derivations:
        id: {populated_from: n_nationkey}
        title: {expr: '{n_name} + " / " + {region.r_name}'}
        code: {expr: 'str({n_nationkey}) + ":" + str({n_regionkey} * 10)'}
        joined: {expr: '{n_name} + {region.r_name}', range: string}
        digits: {expr: '{tens} + {ones} + {tens}', range: string}
        total: {expr: '{tens} + {ones} + {tens}', range: integer}
        open: {expr: '{tens} + {ones}'}
"""


@registry.add("""
SELECT n_nationkey AS id, n_name || ' / ' || r_name AS title,
       CAST(n_nationkey AS VARCHAR) || ':' || CAST(n_regionkey * 10 AS VARCHAR) AS code, n_name || r_name AS joined,
       (n_nationkey // 10) || '' || (n_nationkey % 10) || (n_nationkey // 10) AS digits,
       CAST(2 * (n_nationkey // 10) + n_nationkey % 10 AS BIGINT) AS total,
       CAST(n_nationkey // 10 + n_nationkey % 10 AS DOUBLE) AS "open"
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
""")
def derive_concat(spark, sf_dir):
    """Texts joined by +, also of two source columns where the slot is text; sums where it is a number or open."""
    tens, ones = F.floor(F.col("n_nationkey") / 10).cast("string"), (F.col("n_nationkey") % 10).cast("string")
    nation = table(spark, sf_dir, "nation").withColumns({"tens": tens, "ones": ones, "r_regionkey": F.col("n_regionkey")})
    return derive(spark, sf_dir, "Place", CONCAT_SPEC, nation=nation).records


JOIN_SPEC = """
- class_derivations:
    Purchase:
      populated_from: orders
      joins:
        customer: {join_on: c_custkey}
      slot_derivations:
        order: {populated_from: o_orderkey}
        segment: {populated_from: customer.c_mktsegment}
        share: {expr: '{o_totalprice} / ({customer.c_acctbal} + 20000)'}
        holder: {expr: '{customer.c_name} + ":" + {o_orderstatus}'}
"""


@registry.add("""
SELECT o_orderkey AS "order", c_mktsegment AS segment,
       o_totalprice / (c_acctbal + 20000.0::DOUBLE) AS share, c_name || ':' || o_orderstatus AS holder
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def derive_join(spark, sf_dir):
    """Cross-table references through a left join on a shared key."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return derive(spark, sf_dir, "Purchase", JOIN_SPEC, orders=orders).records


DROPPED_SPEC = """
- class_derivations:
    Purchase:
      populated_from: orders
      joins:
        lineitem: {join_on: o_orderkey}
        customer: {join_on: o_custkey}
      slot_derivations:
        order: {populated_from: o_orderkey}
        flag: {populated_from: lineitem.l_returnflag}
        segment: {populated_from: customer.c_mktsegment}
"""


@registry.add("""
SELECT 'Purchase' AS entity, 'lineitem' AS "table", 'o_orderkey' AS slot,
       'rows beyond the first of their join key are left out' AS message, count(*) - count(DISTINCT l_orderkey) AS n
FROM lineitem WHERE l_orderkey IS NOT NULL HAVING count(*) > count(DISTINCT l_orderkey)
""")
def derive_join_losses(spark, sf_dir):
    """The rows of a join table that its key leaves out, counted in the error channel."""
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return derive(spark, sf_dir, "Purchase", DROPPED_SPEC, lineitem=lines, customer=customer).errors


UNIT_SPEC = """
- class_derivations:
    Size:
      populated_from: part
      slot_derivations:
        part: {populated_from: p_partkey}
        size_cm:
          populated_from: p_size
          unit_conversion: {source_unit: '[in_i]', target_unit: cm}
        weight_kg:
          populated_from: p_retailprice
          unit_conversion: {source_unit: '[lb_av]', target_unit: kg}
        heat_c:
          populated_from: p_size
          unit_conversion: {source_unit: K, target_unit: Cel}
        brand_number:
          populated_from: p_brand
          unit_conversion: {source_unit: g/dL, target_unit: mg/dL, none_if_non_numeric: true}
        brand_digits:
          populated_from: brand_code
          unit_conversion: {source_unit: g/dL, target_unit: mg/dL, none_if_non_numeric: true}
"""


@registry.add("""
SELECT p_partkey AS part, p_size * 2.54::DOUBLE AS size_cm, p_retailprice * 0.45359237::DOUBLE AS weight_kg,
       p_size * 1.0::DOUBLE + -273.15::DOUBLE AS heat_c,
       TRY_CAST(p_brand AS DOUBLE) * 1000.0::DOUBLE AS brand_number,
       TRY_CAST(CASE WHEN p_size > 45 THEN 'A' ELSE split_part(p_brand, '#', 2) END AS DOUBLE) * 1000.0::DOUBLE
           AS brand_digits
FROM part
""")
def derive_unit(spark, sf_dir):
    """Unit conversion by factor and offset; coded missing text becomes null."""
    part = table(spark, sf_dir, "part").withColumn(
        "brand_code", F.when(F.col("p_size") > 45, "A").otherwise(F.substring_index("p_brand", "#", -1))
    )
    return derive(spark, sf_dir, "Size", UNIT_SPEC, part=part).records


NESTED_SPEC = """
- class_derivations:
    Set:
      populated_from: lineitem
      slot_derivations:
        order: {populated_from: l_orderkey}
        line: {populated_from: l_linenumber}
        total:
          object_derivations:
          - class_derivations:
              Quantity:
                populated_from: lineitem
                slot_derivations:
                  value: {populated_from: l_extendedprice}
                  unit: {value: USD}
        observations:
          object_derivations:
          - class_derivations:
              Observation:
                populated_from: lineitem
                slot_derivations:
                  kind: {value: 'OMOP:1'}
                  amount:
                    object_derivations:
                    - class_derivations:
                        Quantity:
                          populated_from: lineitem
                          slot_derivations:
                            value: {populated_from: l_quantity}
                            unit: {value: '{#}'}
          - class_derivations:
              Observation:
                populated_from: lineitem
                slot_derivations:
                  kind: {value: 'OMOP:2'}
                  amount:
                    object_derivations:
                    - class_derivations:
                        Quantity:
                          populated_from: lineitem
                          slot_derivations:
                            value: {expr: '{l_discount} * 100'}
                            unit: {value: '%'}
"""


@registry.add("""
WITH items AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice, 0 AS item, 'OMOP:1' AS kind, l_quantity AS v, '{#}' AS unit
  FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_extendedprice, 1, 'OMOP:2', l_discount * 100.0::DOUBLE, '%' FROM lineitem
)
SELECT l_orderkey AS "order", l_linenumber AS line, l_extendedprice AS total__value, 'USD' AS total__unit,
       item, kind AS observation__kind, v AS observation__amount__value, unit AS observation__amount__unit
FROM items
""")
def derive_nested(spark, sf_dir):
    """Nested objects and a list of objects, flattened to one row per list item."""
    records = derive(spark, sf_dir, "Set", NESTED_SPEC).records
    listed = records.select("order", "line", "total", F.posexplode("observations").alias("item", "observation"))
    return flatten(listed)


DEEP_SPEC = """
- class_derivations:
    Person:
      populated_from: customer
      slot_derivations:
        species: {expr: "'Homo Sapiens'"}
        identity: {populated_from: c_custkey}
        participants:
          object_derivations:
          - class_derivations:
              Participant:
                populated_from: customer
                slot_derivations:
                  identity: {populated_from: c_name}
                  study: {value: TPC}
                  conditions:
                    object_derivations:
                    - class_derivations:
                        Condition:
                          populated_from: customer
                          slot_derivations:
                            concept: {value: 'HP:1'}
                            status:
                              populated_from: c_mktsegment
                              value_mappings: {BUILDING: PRESENT, MACHINERY: ABSENT}
                    - class_derivations:
                        Condition:
                          populated_from: customer
                          slot_derivations:
                            concept: {value: 'HP:2'}
                            status: {expr: '"PRESENT" if {c_acctbal} < 0 else "ABSENT"'}
"""
DEEP_SCHEMA = """
classes:
  Person:
    attributes:
      species:
      identity: {range: integer}
      participants: {range: Participant, multivalued: true}
  Participant:
    attributes:
      identity:
      study:
      conditions: {range: Condition, multivalued: true}
  Condition:
    attributes:
      concept:
      status:
"""


@registry.add("""
SELECT 'Homo Sapiens' AS species, c_custkey AS identity, c_name AS participant__identity,
       'TPC' AS participant__study, 0 AS item, 'HP:1' AS condition__concept,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'PRESENT' WHEN 'MACHINERY' THEN 'ABSENT' END AS condition__status
FROM customer
UNION ALL
SELECT 'Homo Sapiens', c_custkey, c_name, 'TPC', 1, 'HP:2',
       CASE WHEN c_acctbal < 0 THEN 'PRESENT' ELSE 'ABSENT' END
FROM customer
""")
def derive_deep(spark, sf_dir):
    """Person with participants with conditions, all from one row."""
    records = derive(spark, sf_dir, "Person", DEEP_SPEC, DEEP_SCHEMA).records
    people = records.select("species", "identity", F.explode("participants").alias("participant"))
    listed = people.select(
        "species",
        "identity",
        F.struct("participant.identity", "participant.study").alias("participant"),
        F.posexplode("participant.conditions").alias("item", "condition"),
    )
    return flatten(listed)


FANOUT_SPEC = "".join(
    f"""
- class_derivations:
    Measure:
      populated_from: lineitem
      slot_derivations:
        order: {{populated_from: l_orderkey}}
        line: {{populated_from: l_linenumber}}
        kind: {{value: '{kind}'}}
        amount: {{expr: '{expr}'}}
"""
    for kind, expr in [
        ("quantity", "{l_quantity} * 1"),
        ("price", "{l_extendedprice} * (1 - {l_discount})"),
        ("tax", "{l_extendedprice} * {l_tax}"),
        ("discount", "{l_discount} * 100"),
    ]
)


@registry.add("""
SELECT l_orderkey AS "order", l_linenumber AS line, 'quantity' AS kind, l_quantity * 1.0::DOUBLE AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'price', l_extendedprice * (1.0::DOUBLE - l_discount) FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_extendedprice * l_tax FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_discount * 100.0::DOUBLE FROM lineitem
""")
def derive_fanout(spark, sf_dir):
    """Four blocks over one table from a single scan."""
    return derive(spark, sf_dir, "Measure", FANOUT_SPEC).records


ERROR_SPEC = """
- class_derivations:
    Reading:
      populated_from: events
      slot_derivations:
        id: {populated_from: event_id}
        ratio: {expr: '100 / ({user_id} - 7)'}
        doubled: {expr: '{code} * 2'}
        converted:
          populated_from: code
          unit_conversion: {source_unit: g, target_unit: mg}
- class_derivations:
    Reading:
      populated_from: events
      slot_derivations:
        id: {populated_from: event_id}
        ratio: {expr: '{value} / 0'}
- class_derivations:
    Reading:
      populated_from: events
      slot_derivations:
        id: {expr: '__import__("os").getcwd()'}
"""
# The first block fails on text codes and on user 7, the second on every value.
CODE = "CASE WHEN event_type = 'error' THEN 'A' ELSE CAST(user_id AS VARCHAR) END"


def _events_with_code(spark, sf_dir):
    code = F.when(F.col("event_type") == "error", "A").otherwise(F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").withColumn("code", code)


@registry.add(f"""
WITH coded AS (SELECT *, {CODE} AS code FROM events),
raised AS (
  SELECT 'ratio' AS slot, 'division by zero' AS message FROM coded WHERE user_id = 7
  UNION ALL SELECT 'doubled', 'non-numeric value' FROM coded WHERE code = 'A'
  UNION ALL SELECT 'converted', 'non-numeric value' FROM coded WHERE code = 'A'
  UNION ALL SELECT 'ratio', 'division by zero' FROM coded WHERE value IS NOT NULL
)
SELECT 'Reading' AS entity, 'events' AS "table", slot, message, count(*) AS n FROM raised GROUP BY slot, message
UNION ALL
SELECT 'Reading', 'events', '', 'Import expressions are not supported: ''__import__("os").getcwd()''', NULL
""")
def derive_errors(spark, sf_dir):
    """Counts of row errors per slot, and the refused block."""
    return derive(spark, sf_dir, "Reading", ERROR_SPEC, events=_events_with_code(spark, sf_dir)).errors


@registry.add(f"""
WITH coded AS (SELECT *, {CODE} AS code FROM events)
SELECT event_id AS id, 100.0::DOUBLE / (user_id - 7) AS ratio, CAST(code AS DOUBLE) * 2.0::DOUBLE AS doubled,
       CAST(code AS DOUBLE) * 1000.0::DOUBLE AS converted
FROM coded WHERE user_id <> 7 AND code <> 'A'
UNION ALL
SELECT event_id, NULL, NULL, NULL FROM coded WHERE value IS NULL
""")
def derive_lenient(spark, sf_dir):
    """The records that are left when failed rows go to the error channel."""
    return derive(spark, sf_dir, "Reading", ERROR_SPEC, events=_events_with_code(spark, sf_dir)).records


def _streamed(spark, sf_dir):
    """Events in two lots of files, streamed in two runs over one checkpoint; (records, errors)."""
    files, out = scratch(spark, "stream-in"), scratch(spark, "stream-out")
    events = _events_with_code(spark, sf_dir)
    for lot in (0, 1):
        events.where(F.col("event_id") % 2 == lot).repartition(2).write.mode("append").parquet(files)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(files)
        mapper = Mapper(Catalog.of(spark, {"events": stream}), parse_specs([ERROR_SPEC]))
        run_stream(mapper, "Reading", f"{out}/data", f"{out}/checkpoint")
    return stream_results(spark, f"{out}/data", "Reading")


@registry.add(registry.sql["derive_lenient"])
def stream_records(spark, sf_dir):
    """The records that micro-batches leave, over a restart."""
    return _streamed(spark, sf_dir)[0]


@registry.add(registry.sql["derive_errors"])
def stream_errors(spark, sf_dir):
    """The errors of all micro-batches, summed up; the refused block is told once."""
    return _streamed(spark, sf_dir)[1]


UUID_SPEC = """
- class_derivations:
    Participant:
      populated_from: customer
      slot_derivations:
        id: {expr: 'uuid5("https://w3id.org/bdchm/Participant", str({c_custkey}) + ":TPC")'}
        visit: {expr: 'uuid5("6ba7b810-9dad-11d1-80b4-00c04fd430c8", {c_name})'}
"""


def _uuid_sql(namespace_hex: str, name: str) -> str:
    return f"""(
  SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
         translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' ||
         substr(h, 21, 12)
  FROM (SELECT sha1(unhex('{namespace_hex}') || encode({name})) AS h))"""


@registry.add(f"""
SELECT {_uuid_sql('340628fb9e90555db21dd0ebb73e08a2', "CAST(c_custkey AS VARCHAR) || ':TPC'")} AS id,
       {_uuid_sql('6ba7b8109dad11d180b400c04fd430c8', 'c_name')} AS visit
FROM customer
""")
def derive_uuid(spark, sf_dir):
    """Name-based UUIDs from native expressions."""
    return derive(spark, sf_dir, "Participant", UUID_SPEC).records


EMPTY_SPEC = """
- class_derivations:
    Note:
      populated_from: orders
      slot_derivations:
        open: {populated_from: o_orderstatus, value_mappings: {'O': OPEN}}
        urgent: {populated_from: o_orderpriority, value_mappings: {'1-URGENT': 'YES'}}
"""


@registry.add("""
SELECT CASE o_orderstatus WHEN 'O' THEN 'OPEN' END AS open, CASE o_orderpriority WHEN '1-URGENT' THEN 'YES' END AS urgent
FROM orders WHERE o_orderstatus = 'O' OR o_orderpriority = '1-URGENT'
""")
def derive_nonempty(spark, sf_dir):
    """Records with at least one slot set."""
    return derive(spark, sf_dir, "Note", EMPTY_SPEC).nonempty_records
