"""Scoring, de-duplication, ranking and roll-up of findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve.functions.paths import blob_url
from codesieve.functions.scoring import category_rank, finding_score
from codesieve.operators.partitioning import join_wide

LOCATION = ["repository_id", "file_path", "line_number"]


def of_language(rows: DataFrame, repositories: DataFrame, language: str) -> DataFrame:
    """Rows whose repository has ``language``."""
    ids = repositories.where(F.col("language") == language).select(F.col("id").alias("repository_id"))
    return join_wide(rows, ids, "repository_id", "left_semi")


def by_repository(findings: DataFrame, repository_id: str) -> DataFrame:
    """Findings of one repository, best first."""
    return findings.where(F.col("repository_id") == repository_id).orderBy(F.desc("score"), "id")


def pending(findings: DataFrame, flag: str, repositories: DataFrame | None = None, language: str | None = None) -> DataFrame:
    """Findings whose boolean ``flag`` is not set (``enriched``, ``finding_scored``), optionally of one language."""
    rows = findings.where(~F.coalesce(F.col(flag), F.lit(False)))
    return rows if language is None else of_language(rows, repositories, language)


def count_pending(findings: DataFrame, flag: str, repositories: DataFrame | None = None,
                  language: str | None = None) -> DataFrame:
    """Number of pending findings as a one-row table."""
    return pending(findings, flag, repositories, language).agg(F.count("*").alias("n"))


def score_findings(findings: DataFrame, repositories: DataFrame | None = None, case_sensitive: bool = False) -> DataFrame:
    """Set ``score``: type and path, plus a tenth of the repository's score when ``repositories`` is given."""
    if repositories is None:
        return findings.withColumn(
            "score", finding_score(F.col("vulnerability_type"), F.col("file_path"), None, case_sensitive))
    scores = repositories.select(F.col("id").alias("repository_id"), F.col("score").alias("_repo_score"))
    joined = join_wide(findings, scores, "repository_id", "left")
    return joined.withColumn(
        "score",
        finding_score(F.col("vulnerability_type"), F.col("file_path"), F.col("_repo_score"), case_sensitive),
    ).select(*findings.columns)


def _rank() -> Column:
    return F.struct((-F.col("score")).alias("s"), F.col("id").alias("i"))


def deduplicate(findings: DataFrame, include_singletons: bool = False) -> DataFrame:
    """One finding per location: highest score, then lowest id.

    The winner of several carries the sorted distinct pattern ids of all of them; a single finding carries none
    unless ``include_singletons``.  One shuffle; every aggregate combines before it, so copies of a location
    shrink on the map side.
    """
    rest = [c for c in findings.columns if c not in (*LOCATION, "matched_pattern_ids")]
    grouped = findings.groupBy(*LOCATION).agg(
        F.min_by(F.struct(*rest), _rank()).alias("_w"),
        F.array_sort(F.collect_set("pattern_id")).alias("_ids"),
        F.count("*").alias("_n"),
    )
    ids = F.col("_ids") if include_singletons else F.when(F.col("_n") > 1, F.col("_ids")).otherwise(
        F.array().cast("array<string>"))
    ordered = [F.col(c) if c in LOCATION else F.col("_w")[c].alias(c)
               for c in findings.columns if c != "matched_pattern_ids"]
    return grouped.select(*ordered, ids.alias("matched_pattern_ids"))


def deduplicate_language(findings: DataFrame, repositories: DataFrame, language: str,
                         include_singletons: bool = False) -> DataFrame:
    """``deduplicate`` for the repositories of one language; other findings stay as they are."""
    langs = repositories.select(F.col("id").alias("repository_id"), F.col("language").alias("_lang"))
    tagged = join_wide(findings, langs, "repository_id", "left")
    chosen = F.coalesce(F.col("_lang") == language, F.lit(False))
    untouched = tagged.where(~chosen).drop("_lang")
    if "matched_pattern_ids" not in findings.columns:
        untouched = untouched.withColumn("matched_pattern_ids", F.array().cast("array<string>"))
    return deduplicate(tagged.where(chosen).drop("_lang"), include_singletons).unionByName(untouched)


def winners(findings: DataFrame) -> DataFrame:
    """Winning finding per location by window; same rows as ``deduplicate`` without the pattern ids."""
    order = Window.partitionBy(*LOCATION).orderBy(F.desc("score"), "id")
    return findings.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") == 1).drop("_rn")


def losers(findings: DataFrame) -> DataFrame:
    """Findings that de-duplication removes; the findings are made once."""
    order = Window.partitionBy(*LOCATION).orderBy(F.desc("score"), "id")
    return findings.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") > 1).drop("_rn")


def duplicate_locations(findings: DataFrame) -> DataFrame:
    """Locations with more than one finding: their number, pattern ids and the winner's id."""
    return (
        findings.groupBy(*LOCATION)
        .agg(F.count("*").alias("n"), F.array_sort(F.collect_set("pattern_id")).alias("pattern_ids"),
             F.min_by("id", _rank()).alias("winner_id"))
        .where(F.col("n") > 1)
    )


def deduplication_stats(findings: DataFrame) -> DataFrame:
    """Rows before, after and removed."""
    per_location = findings.groupBy(*LOCATION).agg(F.count("*").alias("n"))
    return per_location.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_removed"),
    )


def distinct_locations(findings: DataFrame) -> DataFrame:
    """Distinct locations."""
    return findings.select(*LOCATION).distinct()


def review_queue(findings: DataFrame, repositories: DataFrame, language: str | None = None) -> DataFrame:
    """Findings with their repository and the combined score; unordered, see ``ranked``."""
    if language is not None:
        repositories = repositories.where(F.col("language") == language)
    repos = repositories.select(
        F.col("id").alias("repository_id"), F.col("name").alias("repository_name"),
        F.col("url").alias("repository_url"), "framework", F.col("score").alias("repo_score"))
    joined = join_wide(findings, repos, "repository_id")
    return joined.select(*_queue_columns())


def _queue_columns() -> list[Column]:
    plain = ["repository_id", "pattern_id", "repository_name", "repository_url", "framework", "file_path",
             "line_number", "vulnerability_type", "snippet", "matched_pattern_ids"]
    return [
        F.col("id").alias("finding_id"), *map(F.col, plain), F.col("score").alias("finding_score"),
        F.col("repo_score"), (F.col("score") + F.col("repo_score")).alias("combined_score"),
    ]


def ranked(queue: DataFrame, limit: int | None = None) -> DataFrame:
    """Review order: combined score, then id; ``limit`` keeps the top of it."""
    ordered = queue.orderBy(F.desc("combined_score"), "finding_id")
    return ordered if limit is None else ordered.limit(limit)


def report_rows(
    findings: DataFrame, repositories: DataFrame, local_repositories: DataFrame, language: str | None = None
) -> DataFrame:
    """Review queue with clone path and web address.

    The two small tables are joined first (one row per repository each), so the findings move once.
    """
    if language is not None:
        repositories = repositories.where(F.col("language") == language)
    repos = repositories.select(
        F.col("id").alias("repository_id"), F.col("name").alias("repository_name"),
        F.col("url").alias("repository_url"), "framework", F.col("score").alias("repo_score"),
    ).join(local_repositories.select("repository_id", "local_path"), "repository_id", "left")
    joined = join_wide(findings, repos, "repository_id")
    url = blob_url(F.col("repository_url"), F.col("file_path"), F.col("line_number"), F.col("local_path"))
    return joined.select(*_queue_columns(), "local_path", url.alias("github_url"))


def repository_report(
    findings: DataFrame, repositories: DataFrame, min_score: int = 1, language: str | None = None,
    clone_dir: str | None = None,
) -> DataFrame:
    """Per repository: best score, number of findings and distinct types, over findings of ``min_score`` and more.

    Findings are rolled up before the join, so the join sees one row per repository on both sides.
    """
    per_repo = findings.where(F.col("score") >= min_score).groupBy("repository_id").agg(
        F.max("score").alias("top_score"), F.count("*").alias("finding_count"),
        F.array_sort(F.collect_set("vulnerability_type")).alias("vulnerability_types"))
    if language is not None:
        repositories = repositories.where(F.col("language") == language)
    repos = repositories.select(
        F.col("id").alias("repository_id"), F.col("name").alias("repository_name"),
        F.col("url").alias("repository_url"), F.coalesce("framework", F.lit("")).alias("framework"))
    report = repos.join(per_repo, "repository_id").select(
        "repository_id", "repository_name", "repository_url", "framework", "top_score", "finding_count",
        "vulnerability_types")
    if clone_dir is not None:
        report = report.withColumn("local_path", F.concat_ws("/", F.lit(clone_dir), "repository_id"))
    return report.orderBy(F.desc("top_score"), F.desc("finding_count"), "repository_id")


def by_category(findings: DataFrame) -> DataFrame:
    """Findings in the order their categories are worked off."""
    rank = category_rank(F.col("vulnerability_type"))
    return findings.withColumn("category_rank", rank).orderBy("category_rank", F.desc("score"), "id")
