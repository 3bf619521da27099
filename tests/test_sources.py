"""Readers of real folders, the regex dialect, and matches over several lines."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from codesieve.operators import multiline, scan, tables
from codesieve.plans import triage
from codesieve.sources import files, packs, records, sinks
from codesieve.sources.rules import Rule, spans_lines


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def rule(regex, name="r"):
    return Rule(name, name, regex, "xss", 5)


def test_root_is_cut_off_once(spark, tmp_path):
    root = tmp_path / "checkouts"
    inner = str(root).lstrip("/")
    write(root / "one" / inner / "zz.py", "x = 1")
    write(root / "two" / "a b+c%20.py", "y = 2")
    write(root / "two" / "vendor" / "lib.py", "z = 3")
    found = files.read_source_files(spark, str(root)).select("repository_id", "file_path", "content")
    assert sorted(map(tuple, found.collect())) == [("one", f"{inner}/zz.py", "x = 1"), ("two", "a b+c%20.py", "y = 2")]
    plan = found._jdf.queryExecution().executedPlan()
    scans = [x for x in _leaves(plan) if "FileScan" in x.toString() or "Scan binaryFile" in x.toString()]
    assert scans[0].metrics().apply("numFiles").value() == 2  # the ignored file is not even opened


def _leaves(plan):
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return [leaves.apply(i) for i in range(leaves.size())]


def test_results_with_ill_typed_fields_and_blanks_in_paths(spark, tmp_path):
    good = {"issue_id": 1, "cwe_id": "89", "severity": 5, "files": {"source_file": {"file": "a.py", "line": 3}}}
    loose = {"issue_id": "2", "cwe_id": 79, "severity": "4", "files": {"source_file": {"file": "b.py", "line": "7"}}}
    odd = {"issue_id": 3, "severity": [1], "files": {"source_file": {"line": "x"}}}
    write(tmp_path / "my ok+1" / "scan" / "filtered_a.json", json.dumps({"findings": [good, loose, odd]}))
    write(tmp_path / "p" / "scan" / "filtered_b.json", "{broken")
    write(tmp_path / "p" / "scan" / "filtered_c.json", json.dumps({"other": 1}))
    rows = {r.project: r for r in records.read_sast_results(spark, str(tmp_path)).where("size(findings) > 0").collect()}
    assert set(rows) == {"my ok+1"} and rows["my ok+1"].scan_file == "filtered_a.json"
    flaws = rows["my ok+1"].findings
    assert [(f.issue_id, f.cwe_id, f.severity, f.files.source_file.line) for f in flaws] == [
        (1, "89", 5, 3), (2, "79", 4, 7), (3, None, None, None)]


def test_repository_report_keeps_rows_with_bad_numbers(spark, tmp_path):
    lines = [{"repository_name": "a", "top_score": "7", "finding_count": 2}, {"repository_name": "b", "top_score": "x"},
             {"repository_name": ""}]
    write(tmp_path / "r.json", "\n".join(map(json.dumps, lines)))
    rows = records.read_repo_report(spark, str(tmp_path / "r.json")).orderBy("repository_name").collect()
    assert [(r.repository_name, r.top_score, r.finding_count) for r in rows] == [("a", 7, 2), ("b", None, None)]


@pytest.mark.parametrize("regex,ok", [
    ("foo", True), ("(?P<my_name>foo)", True), ("foo(?#c)", True), ("(?P<a>x)(?P=a)", True), ("[[]?foo", True),
    ("[^[]xx", True), ("(f)?(?(1)oo|c)", True), ("[", False), ("(?P<a_b>x)(?P=a_b)", True), (None, False),
])
def test_only_what_the_scan_can_run_is_valid(spark, regex, ok):
    row = spark.createDataFrame([(regex,)], "regex string").select(packs.regex_compiles(F.col("regex")).alias("ok"))
    assert row.first().ok is ok
    if ok:  # and it runs
        text = spark.createDataFrame([("foo xx",)], "t string")
        assert text.where(scan.matches(F.col("t"), rule(regex))).count() == 1


@pytest.mark.parametrize("regex,line", [("[a[:alpha:]]bc", "abc"), ("[a-z&&[^b]]bc", "abc"), ("[]a]bc", "abc")])
def test_gate_loses_no_hit_of_odd_classes(spark, regex, line):
    text = spark.createDataFrame([(line,)], "t string")
    counts = {gate: text.where(scan.matches(F.col("t"), rule(regex), gate=gate)).count() for gate in (True, False)}
    assert counts[True] == counts[False]


def test_severity_numbers_and_texts(spark, tmp_path):
    entry = {"name": "n", "regex": "x", "vulnerability_type": "xss"}
    values = [9.7, True, " 7 ", "+3", "9.7", "12345678901", 12345678901, -1.5]
    write(tmp_path / "p.json", json.dumps({"patterns": [
        {**entry, "id": str(i), "severity_score": v} for i, v in enumerate(values)]}))
    valid, rejected = packs.load_patterns(spark, str(tmp_path))
    assert {r.id: r.severity_score for r in valid.collect()} == {"0": 9, "1": 1, "2": 7, "3": 3, "7": -1}
    assert {r.reason for r in rejected.collect()} == {"bad_severity_score"} and rejected.count() == 3


def test_many_matches_in_one_file_are_linear(spark):
    text = "a\n" * 100_000 + "b\nc"
    frame = spark.createDataFrame([("r", "f", "", text)], "repository_id string, file_path string, language string, content string")
    found = multiline.scan_texts(frame, [rule("a\n", "a"), rule(r"b\nc", "b")])
    assert found.groupBy("pattern_id").count().orderBy("pattern_id").collect() == [("a", 100_000), ("b", 1)]
    merged = multiline.scan_texts(frame, [rule("a\n")], merge=True).collect()
    assert [(m.line_number, len(m.snippet)) for m in merged] == [(1, 199_999)]


def test_rules_that_ask_for_a_newline_are_found_in_the_whole_run(spark):
    assert spans_lines(r"a\nb") and spans_lines(r"a[\n ]b") and not spans_lines(r"a[^\n]*b") and not spans_lines(r"a\s*b")
    text = [("1", "src/f.py", "python", "x = open(\n  name)\ny")]
    frame = spark.createDataFrame(text, "repository_id string, file_path string, language string, content string")
    repo = [("1", "app", "u", 500, "python", datetime(2025, 5, 1), 10, False, None, 0)]
    repos = spark.createDataFrame(repo, "id string, name string, url string, stars int, language string, "
                                        "last_push timestamp, size_mb int, archived boolean, framework string, score int")
    queue = triage.triage(frame, repos, [rule(r"open\(\n", "open"), rule("y$", "y")], datetime(2025, 6, 1))
    assert sorted(r.line_number for r in queue.collect()) == [1, 3]


def test_done_counts_for_its_pack_only(spark):
    text = [("1", "src/f.py", "python", "hit")]
    frame = spark.createDataFrame(text, "repository_id string, file_path string, language string, content string")
    repos = spark.createDataFrame([("1",)], "id string")
    done = spark.createDataFrame([("1", "php")], "repository_id string, pack string")
    for pack, n in (("php", 0), ("python", 1)):
        assert triage.scan_repositories(frame, repos, [rule("hit")], triage.Settings(pack=pack), done).count() == n


def test_rediscovery_overwrites_with_null(spark):
    schema = "id string, name string, url string, stars int, language string, last_push string, size_mb int, archived boolean, score int"
    old = spark.createDataFrame([("1", "a", "u", 5, "php", "x", 1, False, 9), ("2", "b", "u", 6, "php", "x", 1, False, 8)], schema)
    new = spark.createDataFrame([("1", "a", "u", None, None, "y", 2, True, None)], schema)
    rows = {r.id: r for r in tables.upsert_repositories(old, new).collect()}
    assert (rows["1"].stars, rows["1"].language, rows["1"].score, rows["2"].stars) == (None, None, 9, 6)


def test_file_counts_of_sinks_do_not_grow_with_tasks(spark, tmp_path):
    rows = spark.range(400).selectExpr("concat('r', id % 3) AS repo", "concat('r', id % 3) AS project", "id").repartition(12)
    sinks.write_combined_results(rows, str(tmp_path / "c"))
    sinks.write_high_severity_summary(rows.limit(1), rows, str(tmp_path / "s"), parts=2)
    assert len(list((tmp_path / "c").rglob("*.json"))) == 3
    assert len(list((tmp_path / "s" / "findings").rglob("*.json"))) <= 6


def test_searches_share_one_scan(spark):
    from codesieve.operators.search import CATALOGUE, Search, code_searches

    rows = [("1", "src/a.py", "python", "os.system(x)\npickle.loads(y)"), ("2", "test/a.php", "php", "md5($x); unserialize($y)"),
            ("2", "test/b.php", "php", "password = 'secret1'")]
    frame = spark.createDataFrame(rows, "repository_id string, file_path string, language string, content string")
    found = code_searches(frame, CATALOGUE)
    assert sorted((r.search, r.repository_id, r.line_number) for r in found.collect()) == [
        ("shell_call", "1", 1), ("unpickling", "1", 2), ("unserialize", "2", 1), ("weak_hash", "2", 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(CATALOGUE) >= 10 and plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    stars = spark.createDataFrame([("1", 10), ("2", None)], "id string, stars int")
    some = {"a": Search("system", min_stars=5), "b": Search("md5", min_stars=5), "c": Search("md5")}
    assert sorted((r.search, r.repository_id) for r in code_searches(frame, some, stars).collect()) == [("a", "1"), ("c", "2")]
