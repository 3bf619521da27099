"""Matches that may span lines: whole texts instead of single lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codesieve.operators.scan import _holds, scan_once
from codesieve.sources.dialect import crosses_lines
from codesieve.sources.rules import Rule, spans_lines

OPEN, CLOSE = "\u0001", "\u0002"


SPANS = "array<struct<rule:int,first:int,last:int>>"


def match_spans(content: Column, regex: str) -> Column:
    """Array of (first, last) line numbers of all matches of ``regex`` in a text, in text order.

    Every match is put between two control characters, in one pass of the regex.  Only a text that then holds some is cut
    into lines, whose places in the array are their numbers: the lines of all opening and of all closing characters, in
    order, are the spans.  The work grows with the text and the number of matches.  Control characters already in the text
    are replaced first.
    """
    def count(line: Column, char: str) -> Column:
        return F.length(line) - F.length(F.replace(line, F.lit(char), F.lit("")))

    def closed(line: Column, i: Column) -> Column:
        # A match that ends with the newline itself still ends on the line before.
        before = F.startswith(line, F.lit(CLOSE)).cast("int")
        return F.concat(F.array_repeat(i, before), F.array_repeat(i + 1, count(line, CLOSE) - before))

    def spans(lines: Column) -> Column:
        first = F.flatten(F.transform(lines, lambda line, i: F.array_repeat(i + 1, count(line, OPEN))))
        last = F.flatten(F.transform(lines, closed))
        return F.zip_with(first, last, lambda a, b: F.struct(a.alias("first"), b.alias("last")))

    clean = F.when(F.contains(content, F.lit(OPEN)) | F.contains(content, F.lit(CLOSE)),
                   F.translate(content, OPEN + CLOSE, "\ufffd\ufffd")).otherwise(content)
    marked = F.regexp_replace(clean, F.lit(regex), F.lit(f"{OPEN}$0{CLOSE}"))
    # Passing the marked text through a lambda, and its lines through another, evaluates either once.
    cut = F.transform(F.array(marked), lambda m: F.when(F.contains(m, F.lit(OPEN)), F.split(m, "\n", -1)))
    return F.flatten(F.transform(F.filter(cut, lambda lines: lines.isNotNull()), spans))


def _over_text(rules: Sequence[Rule], whole: frozenset[int], unicode: bool):
    """Spans of the rules at positions ``whole``; texts without a rule's literals are not matched with it."""
    def hits(content: Column, language: Column, groups: dict[str, list[int]]) -> Column:
        own = [lang for lang in groups if lang]
        low = F.lower(F.coalesce(language, F.lit("")))

        def applies(i: int) -> Column:
            languages = [lang for lang in own if i in groups[lang]]
            tests = [low.isin(*languages)] if languages else []
            if i in groups[""]:
                tests.append(~low.isin(*own) if own else F.lit(True))
            return reduce(or_, tests) if tests else F.lit(False)

        def spans_of(i: int) -> Column:
            found = F.transform(
                match_spans(content, rules[i].java_regex(unicode, whole_text=True)),
                lambda s: F.struct(F.lit(i).alias("rule"), s["first"].alias("first"), s["last"].alias("last")))
            literal = _holds(content, rules[i].needles(unicode))
            wanted = applies(i) if literal is None else applies(i) & literal
            return F.when(wanted, found).otherwise(F.array().cast(SPANS))

        return F.flatten(F.array(*[spans_of(i) for i in sorted(whole)]))

    return hits


def scan_texts(
    files: DataFrame,
    rules: Sequence[Rule],
    *,
    context: int | None = None,
    unicode: bool = False,
    strict: bool = False,
    merge: bool = False,
) -> DataFrame:
    """One finding per (file, rule, first line of a match); a match may run over several lines.

    The literal gate runs on the whole text.  The snippet is the matched lines, or the context of the first
    line.  ``merge`` reports matches on touching lines as one finding.
    """
    every = frozenset(range(len(rules)))
    return scan_once(files, rules, _over_text(rules, every, unicode), merged_spans if merge else first_spans, every,
                     context=context, unicode=unicode, strict=strict)


def first_spans(hits: Column) -> Column:
    """One span per (rule, first line): the longest of those that start on the same line.

    ``hits`` holds the spans of each rule in text order, so that equal starts are neighbours and the last is longest.
    """
    return _runs(hits, lambda before, hit: (before["rule"] == hit["rule"]) & (before["first"] == hit["first"]))


def merged_spans(hits: Column) -> Column:
    """Spans of the same rule on the same or on touching lines become one."""
    return _runs(hits, lambda before, hit: (before["rule"] == hit["rule"]) & (hit["first"] <= before["last"] + 1))


def _runs(hits: Column, joins) -> Column:
    """Neighbouring spans for which ``joins(previous, span)`` holds become one; ends never go back in a run."""
    def near(a: Column, b: Column) -> Column:
        return F.coalesce(joins(a, b), F.lit(False))

    heads = F.filter(hits, lambda hit, i: ~near(F.get(hits, i - 1), hit))
    tails = F.filter(hits, lambda hit, i: ~near(hit, F.get(hits, i + 1)))
    return F.zip_with(heads, tails, lambda a, b: F.struct(
        a["rule"].alias("rule"), a["first"].alias("first"), b["last"].alias("last")))


def scan_files(files: DataFrame, rules: Sequence[Rule], *, context: int | None = None, unicode: bool = False,
               strict: bool = False, across_lines: bool = False) -> DataFrame:
    """All rules in one pass: those that ask for a newline over whole texts, the others line by line.

    With ``across_lines``, all rules whose matches may hold a line end (``\\s``, ``[^x]``) run over whole texts.
    """
    crosses = crosses_lines if across_lines else spans_lines
    whole = frozenset(i for i, rule in enumerate(rules) if crosses(rule.regex))
    return scan_once(files, rules, _over_text(rules, whole, unicode), first_spans, whole, context=context,
                     unicode=unicode, strict=strict)


def merge_adjacent(findings: DataFrame) -> DataFrame:
    """Blocks of findings of one rule on consecutive lines of a file: first and last line, and how many.

    Gaps and islands: within one file and rule, ``line - row number`` is constant on a run of lines.
    """
    keys = ["repository_id", "file_path", "pattern_id"]
    order = Window.partitionBy(*keys).orderBy("line_number")
    return (
        findings.select(*keys, "line_number").distinct()
        .withColumn("_island", F.col("line_number") - F.row_number().over(order))
        .groupBy(*keys, "_island")
        .agg(F.min("line_number").alias("line_number"), F.max("line_number").alias("end_line"),
             F.count("*").alias("line_count"))
        .drop("_island")
    )
