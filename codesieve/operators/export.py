"""Selection of repositories for export and the plan of what goes where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.operators.partitioning import join_wide


def export_select(report: DataFrame, min_score: int = 0, min_findings: int = 0) -> DataFrame:
    """Report rows at or above the bounds; a bound of 0 is off and a missing value counts 0."""
    rows = report
    if min_score > 0:
        rows = rows.where(F.coalesce("top_score", F.lit(0)) >= min_score)
    if min_findings > 0:
        rows = rows.where(F.coalesce("finding_count", F.lit(0)) >= min_findings)
    return rows


def _order() -> Column:
    return F.struct((-F.col("top_score")).alias("s"), (-F.col("finding_count")).alias("n"), "repository_id")


def export_names(report: DataFrame) -> DataFrame:
    """Add ``export_name``: the first repository of a name in report order keeps it, later ones append their id.

    The first per name comes from a minimum that combines before the shuffle, so a name shared by very many
    repositories does not end up in one task.
    """
    first = report.groupBy("repository_name").agg(F.min(_order()).alias("_first"))
    joined = join_wide(report, first, "repository_name", "left")
    name = F.when(_order() == F.col("_first"), F.col("repository_name")).otherwise(
        F.concat_ws("_", "repository_name", "repository_id"))
    return joined.withColumn("export_name", name).drop("_first")


def export_plan(
    report: DataFrame, clones: DataFrame, destination: DataFrame, min_score: int = 0, min_findings: int = 0
) -> DataFrame:
    """Outcome per selected repository: ``exported``, ``skipped_missing`` (no clone) or ``skipped_exists``.

    ``clones``: repository_id of present clones; ``destination``: export_name of folders already there.
    Repositories without a clone do not use up a name.
    """
    chosen = export_select(report, min_score, min_findings)
    present = clones.select("repository_id").distinct().withColumn("_present", F.lit(True))
    marked = chosen.join(present, "repository_id", "left")
    named = export_names(marked.where(F.col("_present")))
    taken = destination.select("export_name").distinct().withColumn("_taken", F.lit(True))
    placed = named.join(taken, "export_name", "left")
    outcome = F.when(F.col("_taken"), F.lit("skipped_exists")).otherwise(F.lit("exported"))
    missing = marked.where(F.col("_present").isNull()).withColumn("export_name", F.lit(None).cast("string"))
    columns = [*report.columns, "export_name", "outcome"]
    return placed.withColumn("outcome", outcome).select(*columns).unionByName(
        missing.withColumn("outcome", F.lit("skipped_missing")).select(*columns))
