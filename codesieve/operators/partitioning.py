"""Joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16


def join_hot(
    facts: DataFrame,
    dimension: DataFrame,
    key: str | Sequence[str],
    how: str = "inner",
    spread_by: Column | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``facts`` with a table of at most one row per ``key``, where one key may hold much of the facts.

    Facts of a key are dealt to ``salts`` groups by a hash of ``spread_by`` (default: the whole row) and every
    dimension row is repeated once per group; the result is the plain join.  The extra key column also gives
    both sides a shuffle of their own, which lets adaptive execution split a group that is still too large.

    No broadcast is forced: Spark uses one by itself only if its size estimate of the dimension is below
    ``spark.sql.autoBroadcastJoinThreshold``, so at most ``salts`` times that much is ever sent.
    ``how``: inner, left, left_semi, left_anti.
    """
    keys = [key] if isinstance(key, str) else list(key)
    by = spread_by if spread_by is not None else F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns])
    salted = facts.withColumn("_salt", F.pmod(by, F.lit(salts)).cast("int"))
    repeated = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def join_wide(facts: DataFrame, dimension: DataFrame, key: str | Sequence[str], how: str = "inner") -> DataFrame:
    """``join_hot`` for a dimension that grows with the data: it may have far more keys than the facts refer to.

    The dimension is neither repeated nor sent to every task, whatever its size on disk: both sides move once, by key.
    The extra key column, the same in all rows, gives both sides a shuffle of their own, and what follows a new one, so
    that adaptive execution may split the facts of a hot key among tasks, which all read the same dimension rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    own = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    return facts.withColumn("_own", own).join(dimension.withColumn("_own", own).hint("merge"), [*keys, "_own"], how).drop("_own")
