"""The regex scan: lines of source files against every rule of their language.

The rules are literals of the plan, never a join column: Spark compiles each regex once and Catalyst keeps the
whole scan narrow (no shuffle).  Three gates keep regexes from running at all: the path filter (before the text
is touched), a text gate per file and a text gate per line, both plain substring tests for literals that every
match of a rule must contain.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.constants import IGNORED_PATHS, PATTERN_LANGUAGE
from codesieve.functions.identity import finding_id
from codesieve.functions.paths import is_hidden, is_ignored
from codesieve.functions.text import line_count, raw_lines, window_text
from codesieve.sources.rules import Rule


def eligible_files(
    files: DataFrame,
    ignored: Sequence[str] = IGNORED_PATHS,
    skip_hidden: bool = False,
    skip_binary: bool = False,
) -> DataFrame:
    """Files outside ignored folders; optionally without hidden paths and texts holding a NUL character."""
    kept = files.where(~is_ignored(F.col("file_path"), ignored))
    if skip_hidden:
        kept = kept.where(~is_hidden(F.col("file_path")))
    if skip_binary:
        kept = kept.where(~F.contains(F.col("content"), F.lit("\0")))
    return kept


def rules_by_language(rules: Sequence[Rule], strict: bool = False) -> dict[str, list[int]]:
    """Rule positions per file language; key ``''`` holds the rules for every other language.

    Unless ``strict``, a language that borrows another one's rules gets them.
    """
    groups: dict[str, list[int]] = defaultdict(list)
    for i, rule in enumerate(rules):
        groups[rule.language.lower()].append(i)
    if not strict:
        for borrower, owner in PATTERN_LANGUAGE.items():
            groups[borrower] = sorted(set(groups.get(borrower, []) + groups.get(owner, [])))
    general = groups.pop("", [])
    return {"": general, **{lang: sorted(own + general) for lang, own in groups.items() if own}}


def _by_language(groups: dict[str, list[int]], language: Column, build) -> Column:
    """CASE over the file language with ``build(rule positions)`` in each branch."""
    branches = [(lang, build(positions)) for lang, positions in groups.items() if lang]
    default = build(groups[""])
    if not branches:
        return default
    low = F.lower(language)
    case = F.when(low == branches[0][0], branches[0][1])
    for lang, value in branches[1:]:
        case = case.when(low == lang, value)
    return case.otherwise(default)


def _contains_any(text: Column, texts: Iterable[str]) -> Column:
    """True where ``text`` contains one of ``texts``."""
    return _any([F.contains(text, F.lit(t)) for t in sorted(_shortest(texts))])


def _any(tests: list[Column]) -> Column:
    """Disjunction as a balanced tree: its depth grows with the logarithm of the number of tests."""
    while len(tests) > 1:
        tests = [reduce(or_, tests[i:i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


def _holds(text: Column, needles: tuple[tuple[frozenset[str], ...], bool]) -> Column | None:
    """Substring tests for literal requirements; None if there are none."""
    groups, ignore_case = needles
    haystack = F.lower(text) if ignore_case else text
    return reduce(and_, [_contains_any(haystack, group) for group in groups]) if groups else None


def _shortest(texts: Iterable[str]) -> set[str]:
    """Texts without those that contain another one: for an any-of test the shorter one decides."""
    texts = set(texts)
    return {t for t in texts if not any(o != t and o in t for o in texts)}


def text_gate(text: Column, rules: Sequence[Rule], unicode: bool = False) -> Column:
    """False only where no rule can match ``text``."""
    if not rules:
        return F.lit(False)
    needles = [rule.needles(unicode) for rule in rules]
    if not all(groups for groups, _ in needles):
        return F.lit(True)
    # Rules with one requirement share an any-of test; the others keep their own conjunction.
    tests = []
    for ignore_case in (False, True):
        single = [groups[0] for groups, ic in needles if ic == ignore_case and len(groups) == 1]
        if single:
            tests.append(_holds(text, ((frozenset().union(*single),), ignore_case)))
    tests += [_holds(text, n) for n in dict.fromkeys(n for n in needles if len(n[0]) > 1)]
    return _any(tests)


def matches(text: Column, rule: Rule, unicode: bool = False, gate: bool = True, whole_text: bool = False) -> Column:
    """True where ``rule`` matches somewhere in ``text``, a line or (``whole_text``) several."""
    hit = text.rlike(rule.java_regex(unicode, whole_text))
    test = _holds(text, rule.needles(unicode)) if gate else None
    return hit if test is None else test & hit


def _hits(text: Column, rules: Sequence[Rule], positions: list[int], unicode: bool, gate: bool) -> Column:
    """Array of the positions of all rules that match ``text``.

    ``filter`` (unlike ``array_remove``) keeps the array out of whole-stage code, whose methods would outgrow
    the JVM's limits with a large pack.
    """
    if not positions:
        return F.array().cast("array<int>")
    tests = [F.when(matches(text, rules[i], unicode, gate), i) for i in positions]
    return F.filter(F.array(*tests), lambda i: i.isNotNull())


def rule_attributes(rules: Sequence[Rule], position: Column, *names: str) -> list[Column]:
    """Columns of the rule at ``position``, read from literal arrays in the plan."""
    return [F.get(F.array(*[F.lit(getattr(r, name)) for r in rules]), position).alias(alias)
            for name, alias in (n.split(":") for n in names)]


def scan_lines(
    files: DataFrame,
    rules: Sequence[Rule],
    *,
    context: int | None = None,
    unicode: bool = False,
    strict: bool = False,
    gate: bool = True,
) -> DataFrame:
    """One finding per (file, line, rule that matches the line).

    ``files``: repository_id, file_path, language, content.  Output: the columns of a fresh finding, score 0.
    The snippet is the line, or with ``context`` the line and its neighbours, cut from the lines already at
    hand, so that no second read of the text is needed.
    """
    return scan_once(files, rules, context=context, unicode=unicode, strict=strict, gate=gate)


def scan_once(
    files: DataFrame,
    rules: Sequence[Rule],
    over_text: Callable[[Column, Column, dict[str, list[int]]], Column] | None = None,
    joined: Callable[[Column], Column] | None = None,
    whole: frozenset[int] = frozenset(),
    *,
    context: int | None = None,
    unicode: bool = False,
    strict: bool = False,
    gate: bool = True,
) -> DataFrame:
    """Findings of all rules in one pass over the texts: line by line but for the positions ``whole``.

    For these, ``over_text(content, language, positions by language)`` gives an array of (rule, first, last) line numbers,
    of which ``joined`` makes the spans that are reported.
    """
    if not rules:
        return _no_findings(files)
    groups = rules_by_language(rules, strict)
    by_line = {lang: [i for i in positions if i not in whole] for lang, positions in groups.items()}
    text = files.select("repository_id", "file_path", "language", "content")
    language = F.lower("language")
    if not groups[""]:
        text = text.where(language.isin(*[lang for lang in groups if lang]))

    def gate_for(value: Column, of: dict[str, list[int]]) -> Column:
        return _by_language(
            of, F.col("language"),
            lambda positions: text_gate(value, [rules[i] for i in positions], unicode))

    if gate:
        text = text.where(gate_for(F.col("content"), groups))
    cuts = text.withColumn("_lines", raw_lines(F.col("content"))).select(
        "repository_id", "file_path", "language", "_lines",
        F.coalesce(line_count(F.col("content"), F.col("_lines")), F.lit(0)).alias("_count"),
        *([over_text(F.col("content"), F.col("language"), groups).alias("_whole")] if whole else []))
    if whole:  # a projection of its own: the spans are referred to several times, the matching is done once
        cuts = cuts.withColumn("_whole", joined(F.col("_whole")))

    def shown(number: Column, line: Column) -> Column:
        return line if context is None else window_text(F.col("_lines"), F.col("_count"), number, context)

    def candidate(line: Column) -> Column:
        return F.struct(line["n"].alias("n"), line["line"].alias("line"), shown(line["n"], line["line"]).alias("snippet"),
                        F.lit(None).cast("int").alias("rule"))

    def spanning(hit: Column) -> Column:
        size = F.greatest(F.lit(0), hit["last"] - hit["first"] + 1)
        block = F.array_join(F.slice("_lines", hit["first"], size), "\n")
        return F.struct(hit["first"].alias("n"), F.lit(None).cast("string").alias("line"),
                        shown(hit["first"], block).alias("snippet"), hit["rule"].alias("rule"))

    numbered = F.transform(F.col("_lines"), lambda line, i: F.struct((i + 1).alias("n"), line.alias("line")))
    # The array of lines stays in the file's row: only lines that pass the gate leave it, context included.
    passed = F.filter(
        numbered, lambda x: (x["n"] <= F.col("_count")) & (gate_for(x["line"], by_line) if gate else F.lit(True)))
    leaving = F.transform(passed, candidate)
    if whole:
        inside = F.filter("_whole", lambda hit: hit["first"] <= F.col("_count"))
        leaving = F.concat(leaving, F.transform(inside, spanning))
    candidates = cuts.select("repository_id", "file_path", "language", F.explode_outer(leaving).alias("_c"))
    hits = _by_language(by_line, F.col("language"),
                        lambda positions: _hits(F.col("_c.line"), rules, positions, unicode, gate))
    if whole:
        hits = F.when(F.col("_c.rule").isNotNull(), F.array("_c.rule")).otherwise(hits)
    found = (
        candidates.where(F.col("_c").isNotNull())
        .select("repository_id", "file_path", F.col("_c.n").alias("line_number"), F.col("_c.snippet").alias("snippet"),
                F.explode_outer(hits).alias("_rule"))
        .where(F.col("_rule").isNotNull())
    )
    return _as_findings(found, rules)


def _as_findings(found: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Finding columns for rows (repository_id, file_path, line_number, snippet, _rule)."""
    named = found.select(
        "repository_id", "file_path", "line_number", "snippet",
        *rule_attributes(rules, F.col("_rule"), "id:pattern_id", "vulnerability_type:vulnerability_type"),
    )
    return named.select(
        finding_id(F.col("repository_id"), F.col("file_path"), F.col("line_number"), F.col("pattern_id")).alias("id"),
        "repository_id", "file_path", "line_number", "pattern_id", "vulnerability_type", "snippet",
        F.lit(0).alias("score"),
    )


def _no_findings(files: DataFrame) -> DataFrame:
    empty = files.where(F.lit(False)).select(
        "repository_id", "file_path", F.lit(0).alias("line_number"), F.lit("").alias("snippet"), F.lit(0).alias("_rule"))
    return _as_findings(empty, [Rule("", "", "", "", 0)])
