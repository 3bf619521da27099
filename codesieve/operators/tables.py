"""Table maintenance as DataFrame transforms: inserts, upserts, updates, deletes, checks, work lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.operators.partitioning import join_wide

DISCOVERY_COLUMNS = ["name", "url", "stars", "language", "last_push", "size_mb", "archived"]


def insert_ignore(existing: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``new`` to append: one per key, none whose key exists already."""
    return new.dropDuplicates([key]).join(existing.select(key), key, "left_anti").select(*new.columns)


def last_per_key(batch: DataFrame, key: str, order: str) -> DataFrame:
    """Last row per key in ``order``; combines before the shuffle."""
    rest = [c for c in batch.columns if c != key]
    best = batch.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
    return best.select(key, *[F.col("_row")[c].alias(c) for c in rest])


def upsert_repositories(existing: DataFrame, discovered: DataFrame) -> DataFrame:
    """Repositories after re-discovery: discovery columns come from the batch, nulls too; managed ones keep their value.

    ``discovered`` has one row per id (see ``last_per_key``).
    """
    defaults = {"score": 0, "filtered": False, "scored": False, "framework_detected": False}
    fresh = discovered.select("id", *[F.col(c).alias(f"_{c}") for c in DISCOVERY_COLUMNS], F.lit(True).alias("_hit"))
    joined = existing.join(fresh, "id", "full_outer")
    columns = []
    for name in existing.columns:
        if name in DISCOVERY_COLUMNS:
            columns.append(F.when(F.col("_hit"), F.col(f"_{name}")).otherwise(F.col(name)).alias(name))
        elif name in defaults:
            columns.append(F.coalesce(name, F.lit(defaults[name])).alias(name))
        else:
            columns.append(F.col(name))
    return joined.select(*columns)


def replace_by_key(existing: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Upsert in which a new row replaces the old one entirely (patterns)."""
    return existing.join(new.select(key), key, "left_anti").select(*existing.columns).unionByName(
        new.select(*existing.columns))


def update_by_key(rows: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], flag: str | None = None) -> DataFrame:
    """Set ``columns`` (and the boolean ``flag``) from ``updates`` (one row per key) where the key matches.

    An update may set a column to null; rows without an update keep their values.
    """
    fresh = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = rows.join(fresh, key, "left")
    hit = F.col("_hit").isNotNull()
    out = []
    for name in rows.columns:
        if name in columns:
            out.append(F.when(hit, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name))
        elif name == flag:
            out.append((hit | F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return joined.select(*out)


def mark(rows: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    """Set the boolean ``flag`` for the ids."""
    return update_by_key(rows, ids.select(key).distinct(), key, [], flag)


def delete_by_ids(parents: DataFrame, ids: DataFrame, *children: DataFrame, key: str = "id",
                  foreign_key: str = "repository_id") -> list[DataFrame]:
    """Parents without ``ids`` and each child table without their rows."""
    gone = ids.select(key).distinct()
    kept = [parents.join(gone, key, "left_anti").select(*parents.columns)]
    child_keys = gone.withColumnRenamed(key, foreign_key)
    return kept + [join_wide(child, child_keys, foreign_key, "left_anti").select(*child.columns) for child in children]


def orphans(child: DataFrame, parent: DataFrame, foreign_key: str, key: str = "id") -> DataFrame:
    """Child rows whose parent is missing."""
    return join_wide(child, parent.select(F.col(key).alias(foreign_key)).distinct(), foreign_key, "left_anti").select(
        *child.columns)


def unique_violations(rows: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that occur more than once."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def repeated_texts(rows: DataFrame, text: str) -> DataFrame:
    """``text_md5`` and number of the texts that occur more than once; digests are shuffled, not texts."""
    digests = rows.select(F.md5(text).alias("text_md5"), F.octet_length(text).alias("_size"))
    return digests.groupBy("text_md5", "_size").agg(F.count("*").alias("n")).where(F.col("n") > 1).drop("_size")


def not_done(rows: DataFrame, done: DataFrame, key: str | Sequence[str], force: bool = False) -> DataFrame:
    """Work still to do: rows whose key is not in ``done``; all rows with ``force``."""
    if force:
        return rows
    keys = [key] if isinstance(key, str) else list(key)
    return join_wide(rows, done.select(*keys).distinct(), keys, "left_anti").select(*rows.columns)


def already_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``done``."""
    return join_wide(rows, done.select(key).distinct(), key, "left_semi").select(*rows.columns)


def local_by_language(local_repositories: DataFrame, repositories: DataFrame, language: str,
                      unscanned_only: bool = False) -> DataFrame:
    """Clone records of repositories of one language."""
    rows = local_repositories.where(~F.col("scanned")) if unscanned_only else local_repositories
    ids = repositories.where(F.col("language") == language).select(F.col("id").alias("repository_id"))
    return rows.join(ids, "repository_id", "left_semi")
