"""Report files, written by the executors as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_findings_report(ranked: DataFrame, path: str) -> None:
    """All ranked findings; the part files in name order are the review order."""
    ranked.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_repo_report(report: DataFrame, path: str, clone_dir: str) -> None:
    """Repository roll-up with each repository's clone path."""
    report.withColumn("local_path", F.concat_ws("/", F.lit(clone_dir), "repository_id")).write.mode(
        "overwrite").option("ignoreNullFields", "false").json(path)


def write_combined_results(combined: DataFrame, path: str) -> None:
    """One document per repository, filed under its name: one file each, whatever the number of tasks."""
    combined.withColumn("repository", F.col("repo")).repartition("repository").write.mode("overwrite").partitionBy(
        "repository").json(path)


def write_high_severity_summary(projects: DataFrame, findings: DataFrame, path: str, parts: int = 4) -> None:
    """Project rows under ``projects`` and their flaws under ``findings``, filed by project in at most ``parts`` files.

    A project's flaws are dealt to its files by a hash, so that a hot project is not written by one task.
    """
    projects.write.mode("overwrite").json(f"{path}/projects")
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in findings.columns]), F.lit(parts))
    findings.withColumn("project_dir", F.col("project")).repartition("project_dir", part).write.mode(
        "overwrite").partitionBy("project_dir").json(f"{path}/findings")


def write_triage_report(verdicts: DataFrame, path: str) -> None:
    """Merged verdicts in order."""
    verdicts.write.mode("overwrite").json(path)
