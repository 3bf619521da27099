"""Pattern packs: folders of JSON or YAML files, loaded and validated as DataFrames.

A file holds ``language``, ``cwe_id``, ``cwe_name`` and a list ``patterns``; an entry needs id, name, regex,
vulnerability_type and severity_score and may override the file's language, cwe and cwe_name.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.sources.dialect import java_spelling

REQUIRED = ["id", "name", "regex", "vulnerability_type", "severity_score"]


def regex_compiles(regex: Column) -> Column:
    """True where the regex is one of the packs' dialect and the JVM, which runs it, takes what the scan prints for it."""
    @F.pandas_udf("string")
    def spelled(regexes: pd.Series) -> pd.Series:
        return regexes.map(lambda text: None if text is None else java_spelling(text))

    compiled = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), spelled(regex))
    return regex.isNotNull() & compiled.isNotNull()


# The function for Python workers is nested, so that it travels by value and the workers need not have this
# package installed.


def _yaml_as_json(texts: DataFrame) -> DataFrame:
    """YAML documents as JSON text, null if unreadable."""

    def convert(text: str) -> str | None:
        import yaml

        try:
            return json.dumps(yaml.safe_load(text), default=str)
        except yaml.YAMLError:
            return None

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(value=frame["value"].map(convert))

    return texts.mapInPandas(batches, "source_file string, value string")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Pack documents below ``folder`` as (source_file, value = JSON text)."""
    texts = (
        spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("source_file"), "value")
    )
    as_json = texts.where(F.endswith("source_file", F.lit(".json")))
    as_yaml = texts.where(F.col("source_file").rlike(r"\.ya?ml$"))
    return as_json.unionByName(_yaml_as_json(as_yaml))


def pack_entries(documents: DataFrame) -> DataFrame:
    """One row per entry: (source_file, position, file-level fields, entry as map; null if it is no mapping)."""
    schema = "struct<language:string, cwe_id:string, cwe_name:string, patterns:array<string>>"
    parsed = documents.select("source_file", F.from_json("value", schema).alias("d"))
    rows = parsed.select(
        "source_file", F.posexplode("d.patterns").alias("position", "text"),
        F.col("d.language").alias("file_language"), F.col("d.cwe_id").alias("file_cwe"),
        F.col("d.cwe_name").alias("file_cwe_name"))
    score = F.try_variant_get(F.try_parse_json("text"), "$.severity_score", "variant")
    kind = F.schema_of_variant(score)
    number = F.try_variant_get(score, "$", "double")
    return rows.withColumn(
        "entry", F.when(F.ltrim("text").startswith("{"), F.from_json("text", "map<string,string>"))).withColumn(
        # A number is cut to its whole part and true is 1; text is left to the validation.
        "severity_number", F.when(kind == "BOOLEAN", F.try_variant_get(score, "$", "boolean").cast("int")).when(
            kind != "STRING", F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).try_cast("int"))).drop("text")


def validate_entries(entries: DataFrame, regex_ok: Column | None = None) -> DataFrame:
    """Pattern columns plus ``reason``: null for a valid entry, else why it is rejected.

    Unknown keys are dropped; entry-level language, cwe and cwe_name win over the file's.
    """
    entry = F.col("entry")

    def field(name: str, default: Column | None = None) -> Column:
        value = F.try_element_at(entry, F.lit(name))
        if default is None:
            return value
        return F.coalesce(F.when(F.map_contains_key(entry, name), value), default, F.lit(""))

    has_all = reduce(and_, [F.map_contains_key(entry, name) for name in REQUIRED])
    text = F.trim(field("severity_score"))
    severity = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))
    if "severity_number" in entries.columns:
        severity = F.coalesce("severity_number", severity)
    compiles = regex_compiles(field("regex")) if regex_ok is None else regex_ok
    columns = entries.select(
        *[c for c in ("source_file", "position") if c in entries.columns],
        field("id").alias("id"), field("name").alias("name"), field("regex").alias("regex"),
        field("vulnerability_type").alias("vulnerability_type"), severity.alias("severity_score"),
        field("language", F.col("file_language")).alias("language"), field("cwe", F.col("file_cwe")).alias("cwe"),
        field("cwe_name", F.col("file_cwe_name")).alias("cwe_name"),
        F.when(entry.isNull(), "not_a_mapping").when(~has_all, "missing_fields").when(
            severity.isNull(), "bad_severity_score").alias("_early"),
        compiles.alias("_compiles"),
    )
    reason = F.coalesce("_early", F.when(~F.col("_compiles"), "bad_regex"))
    return columns.withColumn("reason", reason).drop("_early", "_compiles")


def load_patterns(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(valid patterns, rejected entries with reason) of a pack folder."""
    checked = validate_entries(pack_entries(read_documents(spark, folder)))
    valid = checked.where(F.col("reason").isNull()).drop("reason", "source_file", "position")
    return valid, checked.where(F.col("reason").isNotNull())


def pack_stats(checked: DataFrame) -> DataFrame:
    """Loaded and skipped entries per pack file."""
    return checked.groupBy("source_file").agg(
        F.count_if(F.col("reason").isNull()).alias("loaded"), F.count_if(F.col("reason").isNotNull()).alias("skipped"))


def patterns_of(patterns: DataFrame, language: str | None = None, cwe: str | None = None) -> DataFrame:
    """Patterns of a language and/or weakness class, highest severity first."""
    rows = patterns
    if language is not None:
        rows = rows.where(F.col("language") == language)
    if cwe is not None:
        rows = rows.where(F.col("cwe") == cwe)
    return rows.orderBy(F.desc("severity_score"), "id")


def ordered_patterns(patterns: DataFrame) -> DataFrame:
    """All patterns by language, then severity."""
    return patterns.orderBy("language", F.desc("severity_score"), "id")
