"""Search texts for repository discovery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve import constants as C
from codesieve.functions.values import query_text


def search_queries(
    windows: DataFrame, languages: Sequence[str] = C.SEARCH_LANGUAGES, templates: Sequence[str] = C.SEARCH_TEMPLATES,
    min_stars: int = C.MIN_STARS,
) -> DataFrame:
    """One search text per window (window_start, window_end), template and language."""
    rows = windows.select(
        F.col("window_start").cast("string").alias("after"), F.col("window_end").cast("string").alias("before"),
        F.explode(F.array(*map(F.lit, templates))).alias("template")).select(
        "*", F.explode(F.array(*map(F.lit, languages))).alias("language"))
    text = query_text(F.col("template"), F.col("language"), F.lit(min_stars), F.col("after"), F.col("before"))
    return rows.select("language", "after", "before", text.alias("query"))
