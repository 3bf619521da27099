"""Post-processing of static-analysis results and of triage verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve import constants as C
from codesieve.functions.scoring import verdict_weight
from codesieve.operators.partitioning import join_wide


def flaws(results: DataFrame) -> DataFrame:
    """One row per flaw of the result files (project, scan_file, findings array), with its place in the file."""
    rows = results.select("project", "scan_file", F.posexplode("findings").alias("pos", "f"))
    return rows.select(
        F.col("project").alias("repo"), "scan_file", "pos",
        "f.issue_id", F.coalesce("f.cwe_id", F.lit("")).alias("cwe_id"),
        F.coalesce("f.issue_type", F.lit("")).alias("issue_type"), "f.severity",
        F.coalesce("f.files.source_file.file", F.lit("")).alias("file"),
        F.coalesce("f.files.source_file.line", F.lit(0)).alias("line"),
        "f.display_text", "f.flaw_details", "f.description", "f.cwename", "f.stack_dumps")


def per_file(results: DataFrame, cwes: Sequence[str] = C.SAST_CWES, cap: int = C.SAST_CAP,
             at_least: int = C.HIGH_SEVERITY) -> DataFrame:
    """One row per result file: how many flaws qualify, how many are of high severity, and the ``cap`` first that qualify.

    Nothing leaves the file's row: no shuffle, and what later passes need of a file is bounded by ``cap``.
    """
    fields = ["issue_id", "severity", "display_text", "flaw_details", "description", "cwename", "stack_dumps"]

    def ordered(f: Column, pos: Column) -> Column:
        class_ = F.coalesce(f["cwe_id"], F.lit(""))
        return F.struct(
            (-F.coalesce(f["severity"], F.lit(0))).alias("down"), class_.try_cast("long").alias("up"), pos.alias("pos"),
            class_.alias("cwe_id"), F.coalesce(f["issue_type"], F.lit("")).alias("issue_type"),
            F.coalesce(f["files"]["source_file"]["file"], F.lit("")).alias("file"),
            F.coalesce(f["files"]["source_file"]["line"], F.lit(0)).alias("line"), *[f[name].alias(name) for name in fields])

    # The fields in front are the order; what is the same up to ``pos``, which is unique, is never compared.
    wanted = F.filter(F.transform("findings", ordered), lambda f: f["cwe_id"].isin(*cwes))
    return results.select(
        F.col("project").alias("repo"), "scan_file", wanted.alias("wanted"),
        F.size(F.filter("findings", lambda f: F.coalesce(f["severity"], F.lit(0)) >= at_least)).alias("high")).select(
        "repo", "scan_file", F.greatest(F.size("wanted"), F.lit(0)).cast("long").alias("qualifying"),
        F.greatest("high", F.lit(0)).cast("long").alias("high"), F.slice(F.array_sort("wanted"), 1, cap).alias("top"))


def flaws_of(files: DataFrame) -> DataFrame:
    """The flaws that ``per_file`` kept, as ``flaws`` gives them."""
    rows = files.select("repo", "scan_file", F.explode("top").alias("f")).select("repo", "scan_file", "f.*")
    return rows.drop("down", "up")


def counts_of(files: DataFrame, cap: int = C.SAST_CAP) -> DataFrame:
    """``repository_counts`` from the sums that ``per_file`` carries."""
    n = F.sum("qualifying")
    return files.where("qualifying > 0").groupBy("repo").agg(
        n.alias("total_qualifying"), F.least(n, F.lit(cap)).alias("assessed_count"), (n > cap).alias("capped"))


def qualifying(rows: DataFrame, cwes: Sequence[str] = C.SAST_CWES) -> DataFrame:
    """Flaws of the given weakness classes."""
    return rows.where(F.col("cwe_id").isin(*cwes))


def top_per_repository(rows: DataFrame, cap: int = C.SAST_CAP) -> DataFrame:
    """The ``cap`` first flaws per repository: severity down, class up, then file and position.

    Spark keeps only ``cap`` rows per repository and task before the shuffle (WindowGroupLimit), so a repository
    with very many flaws costs no more than one with ``cap`` per task.
    """
    order = Window.partitionBy("repo").orderBy(
        F.desc(F.coalesce("severity", F.lit(0))), F.col("cwe_id").try_cast("long"),
        "scan_file", "pos")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cap)


def repository_counts(rows: DataFrame, cap: int = C.SAST_CAP) -> DataFrame:
    """Per repository: qualifying flaws, assessed ones, and whether the cap cut some off."""
    n = F.count("*")
    return rows.groupBy("repo").agg(
        n.alias("total_qualifying"), F.least(n, F.lit(cap)).alias("assessed_count"), (n > cap).alias("capped"))


def high_severity(rows: DataFrame, at_least: int = C.HIGH_SEVERITY) -> DataFrame:
    """Flaws of high severity; a missing severity counts 0."""
    return rows.where(F.coalesce("severity", F.lit(0)) >= at_least)


def summary(rows: DataFrame, repo_report: DataFrame | None = None, at_least: int = C.HIGH_SEVERITY) -> DataFrame:
    """Per project with high-severity flaws: their number and the repository's name, address and path."""
    counts = high_severity(rows, at_least).groupBy("repo").agg(F.count("*").alias("finding_count"))
    if repo_report is None:
        return counts.select(
            F.col("repo").alias("project"), F.col("repo").alias("repository_name"),
            F.lit(None).cast("string").alias("repository_url"), F.lit(None).cast("string").alias("local_path"),
            "finding_count")
    meta = repo_report.where(F.length("repository_name") > 0).groupBy(F.col("repository_name").alias("repo")).agg(
        # Of several rows with one name the last in report order counts, as in a lookup table filled in order.
        F.max_by(F.struct("repository_name", "repository_url", "local_path"),
                 F.struct(-F.col("top_score"), -F.col("finding_count"), "repository_id")).alias("m"))
    return counts.join(meta, "repo", "left").select(
        F.col("repo").alias("project"), F.coalesce("m.repository_name", "repo").alias("repository_name"),
        F.col("m.repository_url").alias("repository_url"), F.col("m.local_path").alias("local_path"), "finding_count")


def summary_findings(rows: DataFrame, projects: DataFrame, at_least: int = C.HIGH_SEVERITY) -> DataFrame:
    """The high-severity flaws with their project's metadata, one row per flaw.

    A project's flaws stay rows (a nested list per project would put a hot project into one task).
    """
    return join_wide(high_severity(rows, at_least).withColumnRenamed("repo", "project"),
                     projects.select("project", "repository_name", "repository_url", "local_path"), "project")


def triage_targets(rows: DataFrame, cwes: Sequence[str] = C.TRIAGE_CWES) -> DataFrame:
    """Repositories with at least one flaw of the given classes."""
    return qualifying(rows, cwes).select("repo").distinct()


def triage_merge(*reports: DataFrame) -> DataFrame:
    """All verdicts: severity down, verdict weight down, then repository and issue."""
    merged = reports[0]
    for other in reports[1:]:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged.orderBy(F.desc("severity"), F.desc(verdict_weight(F.col("verdict"))), "repo", "issue_id")


def triage_summary(verdicts: DataFrame) -> DataFrame:
    """Repositories, findings and findings per verdict."""
    return verdicts.agg(
        F.count_distinct("repo").alias("repos_assessed"), F.count("*").alias("total_findings"),
        *[F.count_if(F.col("verdict") == v).alias(v) for v in C.VERDICT_WEIGHT])


def verdict_pivot(verdicts: DataFrame) -> DataFrame:
    """Findings per repository and verdict, one column per verdict."""
    return verdicts.groupBy("repo").pivot("verdict", list(C.VERDICT_WEIGHT)).agg(F.count(F.lit(1))).fillna(0)
