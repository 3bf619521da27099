"""Normalisation of discovery values."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from codesieve.constants import LANGUAGE_KEYS, PATTERN_LANGUAGE


def normalize_language(name: Column, fallback: Column | str | None = None) -> Column:
    """Our key for a language name; ``fallback`` stands in for a missing or empty name."""
    default = fallback if isinstance(fallback, Column) else F.lit(fallback).cast("string")
    low = F.lower(F.coalesce(F.when(name != "", name), default))
    pairs = [F.lit(x) for kv in LANGUAGE_KEYS.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), low), low)


def pattern_language(language: Column) -> Column:
    """Language whose patterns apply to files of ``language``."""
    low = F.lower(language)
    pairs = [F.lit(x) for kv in PATTERN_LANGUAGE.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), low), low)


def size_mb(kilobytes: Column) -> Column:
    """Whole megabytes, at least one; unknown sizes count one."""
    kb = F.coalesce(kilobytes, F.lit(0)).cast("long")
    return F.greatest(F.lit(1), ((kb - kb % 1024) / 1024).cast("int"))


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text as timestamp (naive text is session time, which we keep at UTC); null if unreadable."""
    return F.try_to_timestamp(text)


def timestamp_or_epoch(text: Column) -> Column:
    """ISO-8601 text as timestamp, 1970-01-01 if unreadable."""
    return F.coalesce(iso_timestamp(text), F.timestamp_micros(F.lit(0).cast("long")))


def string_list(json_text: Column) -> Column:
    """JSON list of strings as array, empty if unreadable."""
    return F.coalesce(F.from_json(json_text, "array<string>"), F.array().cast("array<string>"))


def pushed_qualifier(after: date | str, before: date | str | None = None) -> str:
    """Search qualifier for a date window."""
    return f"pushed:{after}..{before}" if before else f"pushed:>{after}"


def query_text(
    template: Column, language: Column, min_stars: Column, after: Column, before: Column | None = None
) -> Column:
    """Search text of a template: every placeholder is replaced by its value."""
    upper = F.coalesce(before, F.lit("")) if before is not None else F.lit("")
    pushed = F.when(upper != "", F.concat(F.lit("pushed:"), after, F.lit(".."), upper)).otherwise(
        F.concat(F.lit("pushed:>"), after))
    values = {
        "{language}": language, "{min_stars}": min_stars.cast("string"), "{pushed_after}": after,
        "{pushed_before}": upper, "{pushed}": pushed,
    }
    text = template
    for placeholder, value in values.items():
        text = F.replace(text, F.lit(placeholder), value)
    return text
