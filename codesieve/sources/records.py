"""Nested JSON inputs: scanner events, search nodes, static-analysis results, repository reports, stored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve import schemas
from codesieve.functions import values
from codesieve.functions.identity import finding_id
from codesieve.functions.paths import relativize
from codesieve.operators.partitioning import join_hot


def scanner_findings(events: DataFrame, patterns: DataFrame | None = None) -> DataFrame:
    """Findings from scanner event lines.

    ``events``: value (one JSON line), repository_id, repo_root, pattern_id and, unless ``patterns`` supplies
    it, vulnerability_type.  Blank and malformed lines and events other than matches are skipped.
    """
    parsed = events.withColumn("_e", F.from_json("value", schemas.SCAN_EVENT)).where(F.col("_e.type") == "match")
    if patterns is not None:
        kinds = patterns.select(F.col("id").alias("pattern_id"), "vulnerability_type")
        parsed = join_hot(parsed, kinds, "pattern_id", "inner", F.xxhash64("value"))
    path = relativize(F.coalesce("_e.data.path.text", F.lit("")), F.col("repo_root"))
    located = parsed.select(
        "repository_id", path.alias("file_path"), F.coalesce("_e.data.line_number", F.lit(0)).alias("line_number"),
        "pattern_id", "vulnerability_type",
        F.regexp_replace(F.coalesce("_e.data.lines.text", F.lit("")), "\n+\\z", "").alias("snippet"))
    identity = finding_id(F.col("repository_id"), F.col("file_path"), F.col("line_number"), F.col("pattern_id"))
    return located.select(identity.alias("id"), "*", F.lit(0).alias("score"))


def search_repositories(nodes: DataFrame, fallback_language: Column | str) -> DataFrame:
    """Repositories from search result nodes (columns of ``schemas.SEARCH_NODE``); nodes without an id are dropped."""
    return nodes.where(F.col("databaseId").isNotNull()).select(
        F.col("databaseId").cast("string").alias("id"), "name", "url", F.col("stargazerCount").alias("stars"),
        values.normalize_language(F.col("primaryLanguage.name"), fallback_language).alias("language"),
        values.iso_timestamp(F.col("pushedAt")).alias("last_push"), values.size_mb(F.col("diskUsage")).alias("size_mb"),
        F.coalesce("isArchived", F.lit(False)).alias("archived"),
        F.lit(None).cast("string").alias("framework"), F.lit(0).alias("score"))


def topic_signals(nodes: DataFrame) -> DataFrame:
    """(repository_id, value): the topics of search result nodes."""
    return nodes.where(F.col("databaseId").isNotNull()).select(
        F.col("databaseId").cast("string").alias("repository_id"),
        F.explode("repositoryTopics.nodes.topic.name").alias("value"))


def root_file_signals(files: DataFrame) -> DataFrame:
    """(repository_id, value): the names of files in the root folder."""
    return files.where(~F.contains("file_path", F.lit("/"))).select("repository_id", F.col("file_path").alias("value"))


def read_sast_results(spark: SparkSession, root: str, folder: str = "*", names: str = "filtered_*.json") -> DataFrame:
    """(project, scan_file, findings) of result files ``root/<project>/<folder>/<names>``.

    Only files that are no JSON are skipped; a field of another type is converted or becomes null.
    """
    rows = spark.read.text(f"{root.rstrip('/')}/*/{folder}/{names}", wholetext=True)

    def decoded(name: Column) -> Column:  # the listed path is URL-encoded; a plus sign stands for itself
        return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))

    path = decoded(F.col("_metadata.file_path"))
    return parse_sast_results(rows.where(F.try_parse_json("value").isNotNull()).select(
        F.element_at(F.split(path, "/"), -3).alias("project"), decoded(F.col("_metadata.file_name")).alias("scan_file"),
        "value"))


def parse_sast_results(documents: DataFrame) -> DataFrame:
    """The same for result documents held in a column ``value`` (with project and scan_file)."""
    loose = F.from_json("value", _as_text(schemas.SAST_RESULT))  # numbers may come as text
    parsed = documents.select("project", "scan_file", loose.alias("d"))
    typed = F.transform("d.findings", lambda flaw: F.struct(
        flaw["issue_id"].try_cast("long").alias("issue_id"), flaw["cwe_id"].alias("cwe_id"),
        flaw["issue_type"].alias("issue_type"), flaw["severity"].try_cast("int").alias("severity"),
        F.struct(F.struct(flaw["files"]["source_file"]["file"].alias("file"),
                          flaw["files"]["source_file"]["line"].try_cast("int").alias("line"))
                 .alias("source_file")).alias("files"),
        *[flaw[name].alias(name) for name in ("display_text", "flaw_details", "description", "cwename", "stack_dumps")]))
    return parsed.select(
        "project", "scan_file", F.coalesce(typed, F.array()).cast(_findings_type()).alias("findings"))


def _as_text(schema: str) -> str:
    """A schema whose numbers are read as text."""
    return schema.replace(":bigint", ":string").replace(":int", ":string")


def _findings_type() -> str:
    return schemas.SAST_RESULT.partition(" ")[2]


def read_repo_report(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Rows of a repository report, JSON lines or (``array``) one JSON array.

    Rows without a name are left out; a number that comes as text is converted, one that is none becomes null.
    """
    text = schemas.REPO_REPORT.replace(" int", " string").replace(" bigint", " string")
    reader = spark.read.schema(text).option("mode", "PERMISSIVE")
    rows = (reader.option("multiLine", "true") if array else reader).json(path).where(F.length("repository_name") > 0)
    numbers = {"top_score": "int", "finding_count": "long"}
    return rows.select(*[F.col(c).try_cast(numbers[c]).alias(c) if c in numbers else F.col(c) for c in rows.columns])


def decode_repositories(rows: DataFrame) -> DataFrame:
    """Typed repositories from stored text and 0/1 columns; an unreadable time becomes the epoch."""
    return rows.select(
        "id", "name", "url", F.col("stars").cast("int").alias("stars"), "language",
        values.timestamp_or_epoch(F.col("last_push")).alias("last_push"), F.col("size_mb").cast("int").alias("size_mb"),
        (F.col("archived") != 0).alias("archived"), "framework", F.col("score").cast("int").alias("score"))


def decode_findings(rows: DataFrame) -> DataFrame:
    """Findings with ``matched_pattern_ids`` as array; an unreadable list becomes empty."""
    return rows.withColumn("matched_pattern_ids", values.string_list(F.col("matched_pattern_ids")))


def decode_local_repositories(rows: DataFrame) -> DataFrame:
    """Clone records with typed time and flag."""
    return rows.select("repository_id", "local_path", values.timestamp_or_epoch(F.col("clone_timestamp")).alias(
        "clone_timestamp"), (F.col("scanned") != 0).alias("scanned"))
