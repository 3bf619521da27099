"""Scan rules and the literal texts every match of a rule must contain."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from codesieve.schemas import PATTERNS
from codesieve.sources.dialect import ATOMIC, REPEATS, java_spelling, nodes, ops, parsed


@dataclass(frozen=True)
class Rule:
    """One pattern of a pack.  An empty ``language`` applies to every file."""

    id: str
    name: str
    regex: str
    vulnerability_type: str
    severity_score: int
    language: str = ""
    cwe: str = ""
    cwe_name: str = ""

    def needles(self, unicode: bool = False) -> tuple[tuple[frozenset[str], ...], bool]:
        """(groups, ignore_case): every match contains at least one text of each group."""
        return required_texts(self.regex, unicode)

    def java_regex(self, unicode: bool = False, whole_text: bool = False) -> str:
        """The regex printed for Java (``dialect.java_spelling``)."""
        spelled = java_spelling(self.regex, unicode, whole_text)
        if spelled is None:
            raise ValueError(f"rule {self.id}: not a regular expression: {self.regex!r}")
        return spelled


# A literal this long is selective on its own; shorter ones are combined with up to two more.
_SELECTIVE = 3
# Largest character class that is worth testing one character at a time.
_SMALL_CLASS = 16


def required_texts(regex: str, unicode: bool = False) -> tuple[tuple[frozenset[str], ...], bool]:
    """Conservative literal requirements of ``regex``: (any-of groups that must all hold, ignore_case).

    A wrong literal would lose findings, so whatever is not plainly understood contributes none.
    """
    tree = parsed(regex)
    if tree is None:
        return (), False
    ignore_case = bool(tree.state.flags & re.IGNORECASE)
    if _changes_case(tree) or (ignore_case and unicode):
        return (), False
    groups = _required(tree, unicode)
    if ignore_case:
        groups = [frozenset(text.lower() for text in g) for g in groups if all(text.isascii() for text in g)]
    groups = sorted(set(groups), key=_selectivity, reverse=True)
    if groups and min(map(len, groups[0])) >= _SELECTIVE:
        groups = groups[:1]
    return tuple(groups[:3]), ignore_case


def _selectivity(group: frozenset[str]) -> tuple[int, int, list[str]]:
    return min(map(len, group)), -len(group), sorted(group)


def _changes_case(tree: Iterable) -> bool:
    """True if a group switches case sensitivity on or off."""
    return any(op is ops.SUBPATTERN and (arg[1] | arg[2]) & re.IGNORECASE for op, arg in nodes(tree))


def spans_lines(regex: str) -> bool:
    """True if ``regex`` asks for a newline, so that single lines cannot show all its matches."""
    tree = parsed(regex)
    return tree is not None and _has_newline(tree)


def _has_newline(tree: Iterable) -> bool:
    return any(op is ops.LITERAL and arg == 10 or op is ops.IN and arg[0][0] is not ops.NEGATE and (ops.LITERAL, 10) in arg
               for op, arg in nodes(tree))


_ZERO_WIDTH = {ops.AT, ops.ASSERT, ops.ASSERT_NOT}


def _required(tree: Iterable, unicode: bool) -> list[frozenset[str]]:
    """Any-of groups of a concatenation: each of its parts must occur."""
    groups: list[frozenset[str]] = []
    run = ""
    for op, arg in tree:
        if op is ops.LITERAL:
            run += chr(arg)
            continue
        if op in _ZERO_WIDTH:
            continue
        if run:
            groups.append(frozenset([run]))
            run = ""
        if op is ops.SUBPATTERN:
            groups += _required(arg[3], unicode)
        elif op.name == ATOMIC:
            groups += _required(arg, unicode)
        elif op.name in REPEATS and arg[0] >= 1:
            groups += _required(arg[2], unicode)
        elif op is ops.BRANCH:
            options = [_required(option, unicode) for option in arg[1]]
            if all(options):
                groups.append(frozenset().union(*(max(option, key=_selectivity) for option in options)))
        elif op is ops.IN:
            groups += _small_class(arg, unicode)
    if run:
        groups.append(frozenset([run]))
    # A newline never occurs inside a line, so a literal holding one cannot serve as a line gate.
    return [g for g in groups if not any("\n" in text for text in g)]


def _small_class(items: Iterable, unicode: bool) -> list[frozenset[str]]:
    """The characters of a small positive class, else nothing."""
    chars: set[str] = set()
    for op, arg in items:
        if op is ops.LITERAL:
            chars.add(chr(arg))
        elif op is ops.RANGE and arg[1] - arg[0] < _SMALL_CLASS:
            chars.update(map(chr, range(arg[0], arg[1] + 1)))
        elif op is ops.CATEGORY and arg is ops.CATEGORY_DIGIT and not unicode:
            chars.update("0123456789")
        else:
            return []
    return [frozenset(chars)] if 0 < len(chars) <= _SMALL_CLASS else []


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """The ``patterns`` table of a pack."""
    rows = [(r.id, r.name, r.regex, r.vulnerability_type, r.severity_score, r.language, r.cwe, r.cwe_name)
            for r in rules]
    return spark.createDataFrame(rows, PATTERNS)


def rules_of(patterns: DataFrame) -> list[Rule]:
    """Rules of a ``patterns`` table, in id order.

    A pack is configuration: its regexes become literals of the query plan, so they have to be known when the
    plan is built.
    """
    names = [field.name for field in fields(Rule)]
    return [Rule(**row.asDict()) for row in patterns.select(*names).orderBy("id").toLocalIterator()]
