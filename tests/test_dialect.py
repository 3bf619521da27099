"""Rules mean for the JVM what they mean in the packs' dialect."""

import random
import re

import pytest
from pyspark.sql import functions as F

from codesieve.operators import scan
from codesieve.sources import packs
from codesieve.sources.dialect import crosses_lines, java_spelling, parsed
from codesieve.sources.rules import Rule, required_texts

ALPHABET = "ab1_ \n[]&^-()#P<x>\\.,"


def tree(rng, depth, groups):
    """A random regex; ``groups`` counts those closed so far."""
    kind = rng.randrange(16 if depth else 5)
    if kind == 0:
        return re.escape(rng.choice(ALPHABET))
    if kind == 1:
        return rng.choice(["a", "b", "x", "1", "_"])
    if kind == 2:
        return rng.choice([r"\d", r"\w", r"\s", r"\D", r"\W", r"\S", ".", "[[a]", "[^]b]", r"[\w&&a]", r"[^\W_]", "[a-x-]", r"[\]\\^]"])
    if kind == 3:
        return rng.choice(["^", "$", r"\b", r"\B", r"\A", r"\Z", "(?#note [(]", "(?#x)"])
    if kind == 4:
        return rng.choice([r"\(?#", "[(?#]", r"\(?P<x>", "&&", "#"])
    inner = [tree(rng, depth - 1, groups) for _ in range(rng.randrange(1, 4))]
    body = "".join(inner)
    if kind == 5:
        return "|".join(inner)
    if kind == 6:
        return f"(?:{body}){rng.choice(['*', '+', '?', '{2}', '{1,2}', '*?', '+?', '??', '?+', '{0,2}'])}"
    if kind == 7:
        groups[0] += 1
        return rng.choice([f"({body})", f"(?P<n_{groups[0]}x>{body})"])
    if kind == 8 and groups[0]:
        return rf"\{rng.randrange(1, groups[0] + 1)}" + rng.choice(["", "1"])
    if kind == 9 and groups[0]:
        return f"(?({rng.randrange(1, groups[0] + 1)}){inner[0].replace('|', '')}|{inner[-1].replace('|', '')})"
    if kind == 10:
        return f"({rng.choice(['?=', '?!'])}{body})"
    if kind == 11:
        return f"({rng.choice(['?<=', '?<!'])}{rng.choice(['a', 'ab', '[^x]', chr(92) + 's'])})"
    if kind == 12:
        return f"(?{rng.choice(['i', 's', 'm', '-i', 'is'])}:{body})"
    if kind == 13:
        return f"(?>{body})"
    return body


def subjects(rng):
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 9))) for _ in range(40)] + [
        "", "\n", "a\n", "\na", "(#foo)bar", "x (#foo)bar", "(P<x>y", "?x)y", "AB", "aA", "[", "&", "a11"]


def test_random_regexes_match_alike(spark):
    rng = random.Random(17)
    regexes = []
    while len(regexes) < 2000:
        regex = rng.choice(["", "", "", "(?i)", "(?m)", "(?s)"]) + tree(rng, 3, [0])
        if parsed(regex) is not None:
            regexes.append(regex)
    texts = [text for text in subjects(rng) if text]  # before 3.14, \B does not match an empty text here
    rows = [(i, java_spelling(regex)) for i, regex in enumerate(regexes)]
    frame = spark.createDataFrame(rows, "i int, regex string").repartition(4)
    tests = F.array(*[F.rlike(F.lit(text), F.col("regex")) for text in texts])
    got = dict(frame.select("i", tests).collect())
    for i, regex in enumerate(regexes):
        want = [re.search(regex, text, re.ASCII) is not None for text in texts]
        assert got[i] == want, (regex, rows[i][1], [t for t, a, b in zip(texts, want, got[i], strict=True) if a != b])


def test_gates_lose_no_match():
    rng = random.Random(23)
    tried = 0
    while tried < 3000:
        regex = rng.choice(["", "(?i)"]) + tree(rng, 3, [0])
        if parsed(regex) is None:
            continue
        tried += 1
        groups, ignore_case = required_texts(regex)
        for text in subjects(rng)[::3]:
            line = text.replace("\n", "")  # gates are for single lines
            if re.search(regex, line, re.ASCII):
                held = line.lower() if ignore_case else line
                assert all(any(needle in held for needle in group) for group in groups), (regex, line)


@pytest.mark.parametrize("regex,hits,misses", [
    (r"\(?#foo\)bar", ["x (#foo)bar", "#foo)bar"], ["bar"]),
    (r"eval\(?#\w+\)", ["eval(#a)", "eval#b)"], ["eval(a)"]),
    (r"\(?P<x>y", ["(P<x>y", "P<x>y"], ["xy"]),
    (r"[(?#]x)y", None, None),
    (r"([(?#]x)y", ["(xy", "#xy"], ["xy"]),
    (r"(a)?(?(1)b|c)", ["ab", "c"], ["a"]),
    (r"[[]foo", ["[foo"], ["foo"]),
    (r"[a-z&&[^b]]bc", ["&]bc", "[]bc"], ["abc", "]bc"]),
    (r"(?P<a_b>x)(?P=a_b)", ["xx"], ["x"]),
    (r"(?x) a b # note", ["ab"], ["a b"]),
    (r"\p{L}", None, None),
    ("[", None, None),
])
def test_odd_spellings(spark, regex, hits, misses):
    ok = spark.createDataFrame([(regex,)], "regex string").select(packs.regex_compiles(F.col("regex"))).first()[0]
    assert ok is (hits is not None)
    if not ok:
        with pytest.raises(ValueError):
            Rule("r", "r", regex, "xss", 1).java_regex()
        return
    frame = spark.createDataFrame([(t,) for t in hits + misses], "t string")
    for gate in (True, False):
        got = frame.where(scan.matches(F.col("t"), Rule("r", "r", regex, "xss", 1), gate=gate)).collect()
        assert sorted(r.t for r in got) == sorted(hits)


@pytest.mark.parametrize("regex,crosses", [
    (r"a\nb", True), (r"a\s*b", True), (r"a[^b]c", True), (r"a[^\n]c", False), ("a.b", False), ("(?s)a.b", True),
    ("(?s:a.b)", True), (r"a[\x00-\x20]b", True), (r"a[^\s]b", False), (r"a\Wb", True), (r"a\wb", False), (r"^a$", False)])
def test_what_may_cross_lines(regex, crosses):
    assert crosses_lines(regex) is crosses
