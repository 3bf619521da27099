"""Functions on whole file texts and their lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codesieve.constants import CONTEXT_LINES, EXCERPT_LINES


def raw_lines(content: Column) -> Column:
    """Pieces between newline characters, including the empty piece after a final newline."""
    return F.split(content, "\n", -1)


def line_count(content: Column, pieces: Column) -> Column:
    """Number of lines: the piece after a final newline (or of an empty text) is none."""
    return F.size(pieces) - F.when(F.endswith(content, F.lit("\n")) | (content == ""), 1).otherwise(0)


def lines(content: Column) -> Column:
    """The lines of a text, split at newline only."""
    pieces = raw_lines(content)
    return F.slice(pieces, F.lit(1), line_count(content, pieces))


def window_text(pieces: Column, count: Column, line_number: Column, around: int = CONTEXT_LINES) -> Column:
    """Lines ``line_number`` ± ``around`` clipped to the file, joined by newline, without carriage returns."""
    first = F.greatest(F.lit(1), line_number - around)
    last = F.least(count, line_number + around)
    return _without_returns(F.array_join(F.slice(pieces, first, F.greatest(F.lit(0), last - first + 1)), "\n"))


def _without_returns(text: Column) -> Column:
    """Carriage returns before a line end are dropped."""
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r(?=\n|$)", "")).otherwise(text)


def context_snippet(content: Column, line_number: Column, around: int = CONTEXT_LINES) -> Column:
    """Context of a line in a file text; empty when the file is missing or the line lies outside."""
    pieces = raw_lines(content)
    return F.coalesce(window_text(pieces, line_count(content, pieces), line_number, around), F.lit(""))


def source_excerpt(content: Column, line_number: Column, around: int = EXCERPT_LINES) -> Column:
    """Numbered excerpt around a line with a ``>>>`` marker on it."""
    pieces = raw_lines(content)
    return excerpt_text(pieces, line_count(content, pieces), line_number, around)


def excerpt_text(pieces: Column, count: Column, line_number: Column, around: int = EXCERPT_LINES) -> Column:
    """``source_excerpt`` for a text that is already split."""
    first = F.greatest(F.lit(1), line_number - around)
    last = F.least(count, line_number + around)

    def numbered(text: Column, i: Column) -> Column:
        number = (i + first).cast("string")
        marker = F.when(i + first == line_number, F.lit(" >>> ")).otherwise(F.lit("     "))
        return F.concat(F.lpad(number, F.greatest(F.lit(5), F.length(number)), F.lit(" ")), marker, text)

    shown = F.transform(F.slice(pieces, first, F.greatest(F.lit(0), last - first + 1)), numbered)
    return _without_returns(F.array_join(shown, "\n"))
