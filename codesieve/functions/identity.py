"""Deterministic finding ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codesieve.constants import FINDING_NAMESPACE


def uuid5(key: Column, namespace: str = FINDING_NAMESPACE) -> Column:
    """Name-based UUID (version 5) of ``key``: SHA-1 of namespace bytes and UTF-8 text, version and variant set."""
    prefix = F.unhex(F.lit(namespace.replace("-", "")))
    digest = F.sha1(F.concat(prefix, F.encode(key, "UTF-8")))
    # Variant digit: keep the two low bits of the 17th hex digit, set the top bits to binary 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def finding_id(repository_id: Column, file_path: Column, line_number: Column, pattern_id: Column) -> Column:
    """Id of a finding; the same location and pattern always give the same id."""
    return uuid5(F.concat_ws(":", repository_id, file_path, line_number.cast("string"), pattern_id))
