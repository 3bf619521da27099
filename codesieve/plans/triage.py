"""The whole triage: filter, detect, score, scan, de-duplicate, rank."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve import constants as C
from codesieve.operators.findings import deduplicate, report_rows, review_queue, score_findings
from codesieve.operators.multiline import scan_files
from codesieve.operators.repositories import detect_frameworks, keep_repositories, score_repositories
from codesieve.operators.scan import eligible_files
from codesieve.operators.tables import not_done
from codesieve.sources.rules import Rule
from codesieve.sources.stored import StoredFiles


@dataclass(frozen=True)
class Settings:
    """Thresholds and folders of a run."""

    min_stars: int = C.MIN_STARS
    max_size_mb: int = C.MAX_REPO_SIZE_MB
    ignored_paths: Sequence[str] = C.IGNORED_PATHS
    context: int = C.CONTEXT_LINES
    language: str | None = None
    unicode: bool = False
    strict: bool = False
    skip_hidden: bool = False
    skip_binary: bool = False
    # Name of the rule pack: repositories done with another pack are not done with this one.
    pack: str | None = None


def prepare_repositories(
    repositories: DataFrame, as_of: datetime | Column, settings: Settings = Settings(),
    signals: DataFrame | None = None, files: DataFrame | None = None,
) -> DataFrame:
    """Kept repositories with framework (if ``signals`` are given) and score."""
    kept = keep_repositories(repositories, settings.min_stars, settings.max_size_mb)
    if settings.language is not None:
        kept = kept.where(F.col("language") == settings.language)
    if signals is not None:
        kept = detect_frameworks(kept, signals)
    return score_repositories(kept, as_of, files)


def scan_repositories(
    files: DataFrame | StoredFiles, repositories: DataFrame, rules: Sequence[Rule], settings: Settings = Settings(),
    done: DataFrame | None = None, force: bool = False,
) -> DataFrame:
    """Raw findings, with context, of the files of ``repositories`` that are not ``done`` yet (all with ``force``).

    Files of other repositories are left out before any text is matched.  ``StoredFiles`` do not open their folders and move
    no text; with a plain table it is a semi join, which Spark turns into a broadcast of the ids where they are few.
    ``done``: repository_id, and where it has a column ``pack`` only rows of ``settings.pack`` count.
    """
    ids = repositories.select(F.col("id").alias("repository_id"))
    if done is not None and not force:
        finished = done.where(F.col("pack").eqNullSafe(F.lit(settings.pack))) if "pack" in done.columns else done
        ids = not_done(ids, finished, "repository_id")
    def eligible(texts: DataFrame) -> DataFrame:
        return eligible_files(texts, settings.ignored_paths, settings.skip_hidden, settings.skip_binary)

    if isinstance(files, StoredFiles):
        chosen = eligible(files.of(ids))
    else:
        chosen = eligible(files).join(ids, "repository_id", "left_semi")
    return scan_files(chosen, rules, context=settings.context, unicode=settings.unicode, strict=settings.strict)


def triage(
    files: DataFrame | StoredFiles, repositories: DataFrame, rules: Sequence[Rule], as_of: datetime | Column,
    settings: Settings = Settings(), signals: DataFrame | None = None,
    local_repositories: DataFrame | None = None,
) -> DataFrame:
    """Review queue of the winners, unordered.

    A repository's share of the score is the same for all findings of a location, so it cannot change who wins
    there: findings are scored by type and path and de-duplicated first, and only winners meet the repositories.
    """
    texts = files.files() if isinstance(files, StoredFiles) else files
    repos = prepare_repositories(repositories, as_of, settings, signals, texts)
    found = scan_repositories(files, repos, rules, settings)
    best = deduplicate(score_findings(found))
    queue = review_queue(best, repos) if local_repositories is None else report_rows(best, repos, local_repositories)
    bonus = F.floor(F.col("repo_score") / 10).cast("int")
    return queue.withColumn("finding_score", F.col("finding_score") + bonus).withColumn(
        "combined_score", F.col("finding_score") + F.col("repo_score"))
