"""Scores of findings and repositories."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from codesieve import constants as C


def base_score(vulnerability_type: Column) -> Column:
    """Base score of a vulnerability type, 0 for types without one."""
    first, *rest = C.BASE_SCORES.items()
    chain = reduce(lambda c, kv: c.when(vulnerability_type == kv[0], kv[1]), rest,
                   F.when(vulnerability_type == first[0], first[1]))
    return chain.otherwise(0)


def path_bonus(file_path: Column, case_sensitive: bool = False) -> Column:
    """Bonus for path fragments; by default upper and lower case count alike."""
    path = file_path if case_sensitive else F.lower(file_path)
    return sum((F.when(F.contains(path, F.lit(fragment)), bonus).otherwise(0)
                for fragment, bonus in C.PATH_BONUS.items()), F.lit(0))


def repo_bonus(repo_score: Column) -> Column:
    """A tenth of the repository's score, 0 for an unknown repository."""
    return F.coalesce((repo_score - repo_score % 10) / 10, F.lit(0)).cast("int")


def finding_score(
    vulnerability_type: Column, file_path: Column, repo_score: Column | None = None, case_sensitive: bool = False
) -> Column:
    """Base score plus path bonus plus a tenth of the repository score."""
    score = base_score(vulnerability_type) + path_bonus(file_path, case_sensitive)
    return (score if repo_score is None else score + repo_bonus(repo_score)).cast("int")


def repository_score(
    stars: Column, last_push: Column, framework: Column, has_controllers: Column, as_of: Column | datetime
) -> Column:
    """Stars, recency (strictly less than 180 days before ``as_of``), framework and controllers folder."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(last_push.cast("timestamp"))
    bonuses = [F.when(stars > threshold, bonus).otherwise(0) for threshold, bonus in C.STAR_BONUS.items()]
    bonuses += [
        F.when(age < C.RECENT_SECONDS * 1_000_000, C.RECENT_BONUS).otherwise(0),
        F.when(F.length(framework) > 0, C.FRAMEWORK_BONUS).otherwise(0),
        F.when(has_controllers, C.CONTROLLERS_BONUS).otherwise(0),
    ]
    return sum(bonuses[1:], bonuses[0]).cast("int")


def category_rank(vulnerability_type: Column) -> Column:
    """Position of a type in the order of work; unknown types come last."""
    last = max(C.CATEGORY_PRIORITY.values()) + 1
    return F.coalesce(_lookup(C.CATEGORY_PRIORITY, vulnerability_type), F.lit(last))


def verdict_weight(verdict: Column) -> Column:
    """Weight of a triage verdict, 0 if unknown."""
    return F.coalesce(_lookup(C.VERDICT_WEIGHT, verdict), F.lit(0))


def _lookup(table: dict, key: Column) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)
