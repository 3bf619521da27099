"""Filtering, framework detection and scoring of repositories."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve import constants as C
from codesieve.functions.scoring import repository_score


def reject_reason(min_stars: int = C.MIN_STARS, max_size_mb: int = C.MAX_REPO_SIZE_MB) -> Column:
    """First reason to drop a repository, null if it is kept.  Values equal to a bound are kept.

    Missing stars and sizes count as 0, a missing flag or name as none.
    """
    noise = "|".join(C.NOISE_NAMES)
    return (
        F.when(F.col("archived"), "archived")
        .when(F.coalesce("stars", F.lit(0)) < min_stars, "stars")
        .when(F.coalesce("size_mb", F.lit(0)) > max_size_mb, "size")
        .when(F.lower("name").rlike(noise), "name")
    )


def keep_repositories(repositories: DataFrame, min_stars: int = C.MIN_STARS,
                      max_size_mb: int = C.MAX_REPO_SIZE_MB) -> DataFrame:
    """Repositories worth scanning."""
    # The plain comparisons say nothing new but reach the Parquet scan.
    stars, size = F.col("stars"), F.col("size_mb")
    return repositories.where(
        (stars.isNull() | (stars >= min_stars)) & (size.isNull() | (size <= max_size_mb))
        & reject_reason(min_stars, max_size_mb).isNull())


def filter_stats(repositories: DataFrame, min_stars: int = C.MIN_STARS,
                 max_size_mb: int = C.MAX_REPO_SIZE_MB) -> DataFrame:
    """Number of repositories per outcome (``kept`` or the reject reason)."""
    reason = F.coalesce(reject_reason(min_stars, max_size_mb), F.lit("kept"))
    return repositories.groupBy(reason.alias("outcome")).agg(F.count("*").alias("n"))


def detect_frameworks(repositories: DataFrame, signals: DataFrame) -> DataFrame:
    """Set ``framework`` from root file names and topics; empty text if none is recognised.

    ``signals``: repository_id, value.  Each value is tested against the literal indicators; the smallest
    position of a recognised framework per repository decides, and that minimum combines before the shuffle.
    """
    labels = list(C.FRAMEWORK_INDICATORS)
    value = F.lower("value")
    position = None
    for i, label in enumerate(labels):
        test = reduce(or_, [F.contains(value, F.lit(word)) for word in C.FRAMEWORK_INDICATORS[label]])
        position = F.when(test, i) if position is None else position.when(test, i)
    found = (
        signals.select("repository_id", position.alias("_p")).where(F.col("_p").isNotNull())
        .groupBy("repository_id").agg(F.min("_p").alias("_p"))
    )
    label = F.get(F.array(*map(F.lit, labels)), F.col("_p"))
    return (
        repositories.drop("framework")
        .join(found.withColumnRenamed("repository_id", "id"), "id", "left")
        .withColumn("framework", F.coalesce(label, F.lit("")))
        .drop("_p")
    )


def with_controllers(files: DataFrame) -> DataFrame:
    """Ids of repositories with a root folder ``controllers``."""
    return files.where(F.startswith("file_path", F.lit("controllers/"))).select("repository_id").distinct()


def score_repositories(repositories: DataFrame, as_of: datetime | Column, files: DataFrame | None = None) -> DataFrame:
    """Set ``score``; without ``files`` the controllers bonus is left out, as on a first run."""
    if files is None:
        flagged = repositories.withColumn("_controllers", F.lit(False))
    else:
        ids = with_controllers(files).select(F.col("repository_id").alias("id"), F.lit(True).alias("_controllers"))
        flagged = repositories.join(ids, "id", "left")
    score = repository_score(F.col("stars"), F.col("last_push"), F.col("framework"),
                             F.coalesce("_controllers", F.lit(False)), as_of)
    return flagged.withColumn("score", score).drop("_controllers")


def by_score(repositories: DataFrame) -> DataFrame:
    """Repositories, best first."""
    return repositories.orderBy(F.desc("score"), "id")
