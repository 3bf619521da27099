import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from codesieve import constants as C
from codesieve.operators import multiline, scan, search
from codesieve.operators.partitioning import join_hot, join_wide
from codesieve.packs import builtin_rules
from codesieve.sources import files as file_source
from codesieve.sources.rules import Rule

SCHEMA = "repository_id string, file_path string, language string, content string"


def rule(rid, regex, language="", kind="xss"):
    return Rule(rid, rid, regex, kind, 1, language)


def hits(frame):
    return sorted((r.repository_id, r.file_path, r.line_number, r.pattern_id) for r in frame.collect())


def brute_force(rows, rules, alias=True):
    """The scan by nested loops over files, lines and rules."""
    out = []
    for repo, path, language, content in rows:
        pieces = (content or "").split("\n")
        if pieces and pieces[-1] == "":
            pieces = pieces[:-1]
        for n, line in enumerate(pieces, 1):
            for r in rules:
                own = C.PATTERN_LANGUAGE.get(language, language) if alias else language
                if r.language in ("", own) and re.search(r.regex, line):
                    out.append((repo, path, n, r.id))
    return sorted(out)


ROWS = [
    ("1", "a.py", "python", "eval(x)\nok\n\neval(y); system(z)\n"),
    ("1", "b.ts", "typescript", "evil\r\nreq.query\r\n"),
    ("2", "c.js", "javascript", "req.query eval("),
    ("2", "empty.js", "javascript", ""),
    ("2", "null.js", "javascript", None),
    ("3", "d.java", "java", "é eval(é) req\n"),
]
RULES = [rule("ev", r"eval\s*\("), rule("sys", r"\bsystem\(", "python"), rule("req", r"req\.query", "javascript"),
         rule("any", r"[a-z]{4}"), rule("ci", r"(?i)EVAL\("), rule("nothing", r"^$")]


@pytest.mark.parametrize("gate", [True, False])
def test_scan_equals_brute_force(spark, gate):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    assert hits(scan.scan_lines(frame, RULES, gate=gate)) == brute_force(ROWS, RULES)


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(7)
    rows = [(str(i % 3), f"f{i}", rng.choice(["php", "python", "typescript"]),
             "\n".join("".join(rng.choice("ab1. (e") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(9))))
            for i in range(60)]
    rules = [rule("a", "ab"), rule("b", r"[01]+\.", "php"), rule("c", "a|e"), rule("d", r"(?:a|b)\s*\(", "javascript"),
             rule("e", "^a"), rule("f", "e$", "python"), rule("g", r"b.*1")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert hits(scan.scan_lines(frame, rules)) == brute_force(rows, rules)
    many = rules + [rule(f"x{i}", f"zz{i}q") for i in range(400)]
    assert hits(scan.scan_lines(frame, many)) == brute_force(rows, rules)


def test_finding_columns(spark):
    frame = spark.createDataFrame(ROWS[:1], SCHEMA)
    first = scan.scan_lines(frame, [rule("ev", r"eval\(x", kind="code_injection")]).collect()
    assert len(first) == 1
    row = first[0]
    assert (row.snippet, row.score, row.vulnerability_type) == ("eval(x)", 0, "code_injection")
    assert row.id == str(uuid.uuid5(uuid.UUID(C.FINDING_NAMESPACE), "1:a.py:1:ev"))
    with_context = scan.scan_lines(frame, [rule("ev", r"eval\(y")], context=3).first()
    assert with_context.snippet == "eval(x)\nok\n\neval(y); system(z)"


def test_strict_leaves_typescript_out(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    assert hits(scan.scan_lines(frame, [RULES[2]], strict=True)) == [("2", "c.js", 1, "req")]
    assert hits(scan.scan_lines(frame, [])) == []


def test_unicode_option(spark):
    frame = spark.createDataFrame([("1", "a", "php", "é")], SCHEMA)
    word = [rule("w", r"^\w$")]
    assert hits(scan.scan_lines(frame, word)) == []
    assert len(hits(scan.scan_lines(frame, word, unicode=True))) == 1


def test_eligible_files(spark):
    rows = [("1", p, "php", c) for p, c in
            [("a.php", "x"), ("vendor/a.php", "x"), (".git/a.php", "x"), ("b.php", "x\0y")]]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert {r.file_path for r in scan.eligible_files(frame).collect()} == {"a.php", ".git/a.php", "b.php"}
    kept = scan.eligible_files(frame, skip_hidden=True, skip_binary=True)
    assert [r.file_path for r in kept.collect()] == ["a.php"]


def test_builtin_pack_runs(spark):
    rows = [("1", "a.php", "php", "<?php\n eval($_GET['c']);\n"), ("1", "b.tsx", "typescript", "exec(req.query.c)"),
            ("1", "c.py", "python", "eval('1')")]
    found = scan.scan_lines(spark.createDataFrame(rows, SCHEMA), builtin_rules())
    assert [h[1:] for h in hits(found)] == [("a.php", 2, "php_code_injection_eval"),
                                            ("b.tsx", 1, "javascript_command_injection_exec")]


def test_read_source_files(spark, tmp_path):
    for path, data in {"r1/src/a.php": b"<?php\n", "r1/vendor/b.php": b"x", "r2/c.py": b"\xff\n", "r2/d.txt": b"x"}.items():
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)
    rows = {(r.repository_id, r.file_path): (r.language, r.content)
            for r in file_source.read_source_files(spark, str(tmp_path)).collect()}
    assert rows == {("r1", "src/a.php"): ("php", "<?php\n"), ("r2", "c.py"): ("python", "�\n")}
    only = file_source.read_source_files(spark, str(tmp_path), languages=["python"]).collect()
    assert [r.file_path for r in only] == ["c.py"]


# --- matches over several lines --------------------------------------------------------------


def spans_by_library(text, regex):
    return [(text.count("\n", 0, m.start()) + 1, m.group()) for m in re.finditer(regex, text, re.M)]


@pytest.mark.parametrize("regex", [r"new\s+Doc.*\n.*load", r"a\s*\(", "b", r"x[^y]*y"])
def test_multiline_equals_library(spark, regex):
    text = "new  Doc();\nd.load(a\n(b)b\n\nx1\n2\n3y xy\na (\n"
    frame = spark.createDataFrame([("1", "f", "php", text)], SCHEMA)
    got = sorted(r.line_number for r in multiline.scan_texts(frame, [rule("m", regex)]).collect())
    assert got == sorted({line for line, _ in spans_by_library(text, regex)})


def test_multiline_snippet_languages_and_merge(spark):
    text = "a\na\nq\na\n"
    frame = spark.createDataFrame([("1", "f", "php", text), ("1", "g", "java", text)], SCHEMA)
    rules = [rule("m", "a", "php"), rule("n", "q\na", "php")]
    plain = multiline.scan_texts(frame, rules).collect()
    assert sorted((r.file_path, r.pattern_id, r.line_number, r.snippet) for r in plain) == [
        ("f", "m", 1, "a"), ("f", "m", 2, "a"), ("f", "m", 4, "a"), ("f", "n", 3, "q\na")]
    merged = multiline.scan_texts(frame, rules, merge=True).collect()
    assert sorted((r.pattern_id, r.line_number, r.snippet) for r in merged) == [
        ("m", 1, "a\na"), ("m", 4, "a"), ("n", 3, "q\na")]
    blocks = multiline.merge_adjacent(scan.scan_lines(frame, rules[:1])).collect()
    assert sorted((b.line_number, b.end_line, b.line_count) for b in blocks) == [(1, 2, 2), (4, 4, 1)]


# --- search and skew -------------------------------------------------------------------------


def test_code_search(spark):
    frame = spark.createDataFrame(
        [("1", "src/api/a.py", "python", "yaml.load(x)\nyamlxload"), ("2", "test/a.py", "python", "yaml.load(x)"),
         ("3", "b.py", "python", "yaml.load"), ("1", "c.php", "php", "yaml.load")], SCHEMA)
    repos = spark.createDataFrame([("1", 101), ("2", 500), ("3", 100)], "id string, stars int")
    found = search.code_search(frame, search.Search("yaml.load", "Python", ("test",), 100, quoted=True), repos).collect()
    assert [(r.repository_id, r.line_number, r.path_tags) for r in found] == [("1", 1, ["api"])]
    every = search.code_search(frame, search.Search("yaml.load"))
    assert every.count() == 5


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_hot_is_the_plain_join(spark, how):
    facts = spark.range(300).select(F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 7).alias("k"), "id")
    dims = spark.createDataFrame([(0, "a"), (1, "b"), (9, "c")], "k int, v string")
    expected = sorted(map(str, facts.join(dims, "k", how).collect()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for bytes_ in (threshold, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bytes_)
            hot = join_hot(facts, dims, "k", how)
            assert hot.columns == facts.join(dims, "k", how).columns
            assert sorted(map(str, hot.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_wide_is_the_plain_join(spark, how):
    """Null and repeated keys included; the facts of a hot key are split among tasks."""
    facts = spark.range(3000).select(F.when(F.col("id") % 50 == 7, None).when(F.col("id") < 2000, 0)
                                     .otherwise(F.col("id") % 7).cast("int").alias("k"), "id").repartition(4)
    dims = spark.createDataFrame([(0, "a"), (1, "b"), (1, "b"), (9, "c"), (None, "d")], "k int, v string")
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}
    before = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        wide = join_wide(facts, dims, "k", how)
        assert wide.columns == facts.join(dims, "k", how).columns
        assert sorted(map(str, wide.collect())) == sorted(map(str, facts.join(dims, "k", how).collect()))
        rolled = wide.groupBy("k", "id").count()  # a grouping that the join's own shuffle would do for, but for a split
        rolled.collect()
        assert "skew=true" in rolled._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_repositories_are_neither_sent_nor_repeated(spark):
    """A table of repositories that looks small on disk is as large as any other in memory."""
    from codesieve.operators import findings

    rows = [("1", "src/a.py", "python", "token\nno"), ("2", "b.py", "python", "token"), (None, "c.py", "python", "token")]
    frame = spark.createDataFrame(rows, SCHEMA)
    repos = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.col("id").cast("int").alias("stars"),
                                     F.lit("en").alias("language"), F.lit(10).alias("score"))
    rule = Rule("t", "t", "token", "xss", 3)
    found = scan.scan_lines(frame, [rule])
    for joined in (search.code_search(frame, search.Search("token", min_stars=1), repos),
                   findings.of_language(found, repos, "en"), findings.score_findings(found, repos)):
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert all("_rule" in line or "_c" in line for line in plan.splitlines() if "Generate" in line)
