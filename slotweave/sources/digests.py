"""Study digests: data dictionaries and variable reports as XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotweave.functions.text import accession, table_id

DICTIONARY_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField(
        "value",
        T.ArrayType(T.StructType([T.StructField("_code", T.StringType()), T.StructField("_VALUE", T.StringType())])),
    ),
])
REPORT_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("_var_name", T.StringType()),
    T.StructField("_calculated_type", T.StringType()),
    T.StructField("_units", T.StringType()),
    T.StructField("description", T.StringType()),
])


def digest_key(path: Column) -> Column:
    """File name without its suffix and its participant-set part."""
    name = F.substring_index(path, "/", -1)
    stem = F.regexp_replace(name, r"\.(data_dict|var_report)\.xml$", "")
    return F.array_join(F.filter(F.split(stem, r"\."), lambda x: ~x.rlike(r"^p\d+$")), ".")


def pair_digests(dictionaries: DataFrame, reports: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """(pairs of dictionary and report, dictionaries without a report)."""
    left = dictionaries.select(digest_key(F.col(path)).alias("digest"), F.col(path).alias("data_dict"))
    right = (
        reports.select(digest_key(F.col(path)).alias("digest"), F.col(path).alias("var_report"))
        .groupBy("digest")
        .agg(F.max("var_report").alias("var_report"))
    )
    return left.join(right, "digest"), left.join(right, "digest", "left_anti")


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    df = spark.read.format("xml").option("rowTag", "variable").schema(schema).load(paths)
    return df.withColumn("path", F.col("_metadata.file_path"))


def _first_of_each(values):
    """(code, text) entries; of a repeated code the first counts, an entry without code and text is dropped."""
    entries = F.transform(values, lambda v: F.struct(F.coalesce(v["_code"], v["_VALUE"]).alias("code"), v["_VALUE"].alias("text")))
    codes = F.transform(values, lambda v: F.coalesce(v["_code"], v["_VALUE"]))
    return F.filter(entries, lambda e, i: e["code"].isNotNull() & (F.array_position(codes, e["code"]) == i + 1))


def data_dictionary(spark: SparkSession, dictionaries: list[str], reports: list[str]) -> DataFrame:
    """Variables of the paired digest files: table, variable, name, description, type, unit, codes.

    The calculated type and unit of the report win over the dictionary's.
    """
    return paired_variables(_read(spark, dictionaries, DICTIONARY_SCHEMA), _read(spark, reports, REPORT_SCHEMA))


def data_dictionary_of_texts(dictionaries: DataFrame, reports: DataFrame) -> DataFrame:
    """The same of digests that are rows of (path, text), each a whole XML document; a null or broken one has no variables."""
    return paired_variables(_parsed(dictionaries, DICTIONARY_SCHEMA), _parsed(reports, REPORT_SCHEMA))


def _parsed(texts: DataFrame, schema: T.StructType) -> DataFrame:
    document = T.StructType([T.StructField("variable", T.ArrayType(schema))])
    parsed = texts.select("path", F.from_xml("text", document).alias("doc"))
    return parsed.select("path", F.explode("doc.variable").alias("v")).select("v.*", "path")


def paired_variables(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Dictionary variables with their path, of digests with a report, joined with the report's variables."""
    left = ours.select(
        digest_key(F.col("path")).alias("digest"),
        table_id("path").alias("table"),
        accession("_id").alias("variable"),
        "name",
        "description",
        "type",
        "unit",
        F.map_from_entries(_first_of_each(F.col("value"))).alias("codes"),
    )
    right = (
        theirs.select(
            digest_key(F.col("path")).alias("digest"),
            accession("_id").alias("variable"),
            F.struct("_calculated_type", "_units").alias("r"),
        )
        .groupBy("digest", "variable")
        .agg(F.max("r").alias("r"))
    )
    paired = right.select("digest").distinct()
    joined = left.join(paired, "digest", "left_semi").join(right, ["digest", "variable"], "left")
    return joined.select(
        "table",
        "variable",
        "name",
        "description",
        F.coalesce("r._calculated_type", "type").alias("type"),
        F.coalesce("r._units", "unit").alias("unit"),
        "codes",
    )
