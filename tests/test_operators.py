import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from codesieve import schemas
from codesieve.operators import context, discovery, export, findings, repositories, sast, tables, windows
from codesieve.plans import sast as sast_plan
from codesieve.plans import triage as triage_plan
from codesieve.sources import records, sinks
from codesieve.sources.rules import Rule

FINDING = "id string, repository_id string, file_path string, line_number int, pattern_id string, vulnerability_type string, snippet string, score int"
REPO = "id string, name string, url string, stars int, language string, last_push timestamp, size_mb int, archived boolean, framework string, score int"
NOW = datetime(2025, 6, 1)


def finding(fid, line=1, score=0, pattern="p", repo="1", path="a.py", kind="xss"):
    return (fid, repo, path, line, pattern, kind, "s", score)


def repo(rid, name="app", stars=500, language="python", size=50, archived=False, framework=None, score=0):
    return (rid, name, f"https://h/o/{rid}", stars, language, NOW - timedelta(days=30), size, archived, framework, score)


def ids(frame, column="id"):
    return sorted(r[column] for r in frame.collect())


# --- repositories ----------------------------------------------------------------------------


@pytest.mark.parametrize("row,reason", [
    (repo("1"), None), (repo("1", stars=99), "stars"), (repo("1", stars=100), None), (repo("1", size=200), None),
    (repo("1", size=201), "size"), (repo("1", archived=True, stars=5000), "archived"),
    *[(repo("1", name=n), "name") for n in ("tutorial_of_sorts", "kiosk-example", "demo-lamp", "gym-practice",
                                            "vim-cheatsheet", "awesome-maps", "The-TUTORIAL")],
    (repo("1", name="lantern-api"), None), (repo("1", name="awesomest"), None),
    (repo("1", stars=None), "stars"), (repo("1", size=None), None), (repo("1", name=None), None),
    (repo("1", archived=None), None),
])
def test_repository_filter(spark, row, reason):
    frame = spark.createDataFrame([row], REPO)
    assert frame.select(repositories.reject_reason()).first()[0] == reason
    assert repositories.keep_repositories(frame).count() == (reason is None)
    assert repositories.filter_stats(frame).first().outcome == (reason or "kept")


@pytest.mark.parametrize("signals,expected", [
    (["artisan", "composer.json"], "laravel"), (["composer.json"], "php"), (["Startup.cs"], "aspnetcore"),
    (["README.md", "my-django-app"], "django"), (["flask", "express"], "express"), (["Microsoft.AspNetCore"], "aspnetcore"),
    (["spring-boot-starter"], "spring"), (["fastapi"], "fastapi"), (["@nestjs/core"], "nestjs"), (["koa"], "koa"),
    (["symfony.lock", "composer.json"], "symfony"), (["Fastify"], "fastify"), (["main.go"], ""), ([], ""),
])
def test_framework(spark, signals, expected):
    values = spark.createDataFrame([("1", s) for s in signals], "repository_id string, value string")
    frame = spark.createDataFrame([repo("1")], REPO)
    assert repositories.detect_frameworks(frame, values).first().framework == expected


def test_controllers_folder_counts_at_the_root_only(spark):
    files = spark.createDataFrame([("1", "controllers/a.py"), ("2", "app/controllers/a.py"), ("3", "Controllers/a")],
                                  "repository_id string, file_path string")
    frame = spark.createDataFrame([repo("1"), repo("2"), repo("3")], REPO)
    scored = {r.id: r.score for r in repositories.score_repositories(frame, NOW, files).collect()}
    assert scored == {"1": 10, "2": 4, "3": 4}
    assert ids(repositories.by_score(repositories.score_repositories(frame, NOW))) == ["1", "2", "3"]


def test_search_nodes(spark):
    base = {"databaseId": 5, "name": "n", "url": "u", "stargazerCount": 3, "pushedAt": "2024-01-15T10:30:00Z"}
    topics = {"nodes": [{"topic": {"name": "django"}}, {"topic": {"name": "web"}}]}
    nodes = [
        {**base, "primaryLanguage": {"name": "C#"}, "diskUsage": 2048, "isArchived": True, "repositoryTopics": topics},
        {**base, "databaseId": 6, "primaryLanguage": None, "diskUsage": 0},
        {**base, "databaseId": 7, "primaryLanguage": {}}, {**base, "databaseId": None}, None]
    lines = spark.createDataFrame([(json.dumps(n),) for n in nodes], "value string")
    frame = lines.select(F.from_json("value", schemas.SEARCH_NODE).alias("n")).select("n.*")
    rows = {r.id: r for r in records.search_repositories(frame, "PHP").collect()}
    assert set(rows) == {"5", "6", "7"}
    assert (rows["5"].language, rows["5"].size_mb, rows["5"].archived) == ("csharp", 2, True)
    assert (rows["6"].language, rows["6"].size_mb, rows["6"].archived) == ("php", 1, False)
    assert rows["7"].language == "php" and rows["5"].last_push == datetime(2024, 1, 15, 10, 30)
    assert [(r.repository_id, r.value) for r in records.topic_signals(frame).collect()] == [("5", "django"), ("5", "web")]


# --- de-duplication, scores, queue -----------------------------------------------------------


def dedup(spark, *rows, **options):
    out = findings.deduplicate(spark.createDataFrame(list(rows), FINDING), **options).collect()
    return {r.id: r.matched_pattern_ids for r in out}


def test_dedup_cases(spark):
    assert dedup(spark, finding("a"), finding("b", 2)) == {"a": [], "b": []}
    assert dedup(spark, finding("a", score=3, pattern="x"), finding("b", score=9, pattern="y")) == {"b": ["x", "y"]}
    assert dedup(spark, finding("later", score=5), finding("early", score=5)) == {"early": ["p"]}
    assert set(dedup(spark, *[finding(f, path=f) for f in "abc"])) == {"a", "b", "c"}
    assert dedup(spark, finding("a", pattern="q"), include_singletons=True) == {"a": ["q"]}


def test_dedup_of_one_language(spark):
    rows = [finding("a"), finding("b", score=1), finding("c", repo="2"), finding("d", repo="2"), finding("e", repo="9")]
    repos = spark.createDataFrame([repo("1"), repo("2", language="php")], REPO)
    out = findings.deduplicate_language(spark.createDataFrame(rows, FINDING), repos, "python")
    assert ids(out) == ["b", "c", "d", "e"]


def test_dedup_random_equals_window_and_losers(spark):
    rng = random.Random(3)
    rows = [finding(f"{i:04d}", rng.randrange(8), rng.randrange(4), f"p{rng.randrange(5)}", str(rng.randrange(2)))
            for i in range(400)] + [finding(f"x{i:04d}", 99, 7, "hot") for i in range(300)]
    frame = spark.createDataFrame(rows, FINDING)
    groups = {}
    for r in rows:
        groups.setdefault(r[1:4], []).append(r)
    expected = sorted(min(g, key=lambda r: (-r[7], r[0]))[0] for g in groups.values())
    best = findings.deduplicate(frame)
    assert ids(best) == ids(findings.winners(frame)) == expected
    assert ids(findings.losers(frame)) == sorted({r[0] for r in rows} - set(expected))
    stats = findings.deduplication_stats(frame).first()
    assert (stats.rows_before, stats.rows_after, stats.rows_removed) == (700, len(groups), 700 - len(groups))
    assert findings.distinct_locations(frame).count() == len(groups)
    patterns = {r.id: r.matched_pattern_ids for r in best.collect()}
    for g in groups.values():
        winner = min(g, key=lambda r: (-r[7], r[0]))[0]
        assert patterns[winner] == (sorted({r[4] for r in g}) if len(g) > 1 else [])


def test_empty_findings(spark):
    frame = spark.createDataFrame([], FINDING)
    assert findings.deduplicate(frame).count() == 0
    assert findings.deduplication_stats(frame).first().rows_removed == 0


def test_queue_report_and_scores(spark):
    repos = spark.createDataFrame([repo("1", score=33), repo("2", language="php", framework="laravel", score=4), repo("3")], REPO)
    rows = [finding("a", kind="ssrf", path="/clones/1/routes/x"), finding("b", repo="2"), finding("c", repo="8", kind="unknown"),
            finding("d", repo="3", kind="unknown")]
    scored = findings.score_findings(spark.createDataFrame(rows, FINDING), repos)
    assert {r.id: r.score for r in scored.collect()} == {"a": 12, "b": 3, "c": 0, "d": 0}
    best = findings.deduplicate(scored)
    queue = findings.ranked(findings.review_queue(best, repos)).collect()
    assert [(q.finding_id, q.combined_score) for q in queue] == [("a", 45), ("b", 7), ("d", 0)]
    assert [q.finding_id for q in findings.ranked(findings.review_queue(best, repos, "php"), 1).collect()] == ["b"]
    local = spark.createDataFrame([("1", "/clones/1")], "repository_id string, local_path string")
    rows = {r.finding_id: (r.local_path, r.github_url) for r in findings.report_rows(best, repos, local).collect()}
    assert rows["a"] == ("/clones/1", "https://h/o/1/blob/HEAD/routes/x#L1")
    assert rows["b"] == (None, "https://h/o/2/blob/HEAD/a.py#L1")
    report = findings.repository_report(best, repos, clone_dir="/c").collect()
    assert [(r.repository_id, r.top_score, r.finding_count, r.vulnerability_types, r.framework, r.local_path) for r in report] == [
        ("1", 12, 1, ["ssrf"], "", "/c/1"), ("2", 3, 1, ["xss"], "laravel", "/c/2")]
    assert [r.id for r in findings.by_category(scored).collect()] == ["a", "b", "c", "d"]


def test_pending(spark):
    frame = spark.createDataFrame([("1", True, "1"), ("2", False, "1"), ("3", None, "2")], "id string, enriched boolean, repository_id string")
    repos = spark.createDataFrame([repo("1"), repo("2", language="php")], REPO)
    assert ids(findings.pending(frame, "enriched")) == ["2", "3"]
    assert findings.count_pending(frame, "enriched", repos, "php").first().n == 1


# --- context ---------------------------------------------------------------------------------


def test_attach_context(spark):
    text = "\n".join(f"l{i}" for i in range(1, 11))
    files = spark.createDataFrame([("1", "a.py", text)], "repository_id string, file_path string, content string")
    rows = [finding("a", 5), finding("b", 1), finding("c", 1, path="gone"), finding("d", 1, repo="2"), finding("e", 5)]
    out = {r.id: r.snippet for r in context.attach_context(spark.createDataFrame(rows, FINDING), files).collect()}
    assert out == {"a": "l2\nl3\nl4\nl5\nl6\nl7\nl8", "b": "l1\nl2\nl3\nl4", "c": "", "d": "s", "e": out["a"]}
    window = {r.line_number: r.snippet for r in context.context_by_window(files).collect()}
    assert window[5] == out["a"] and window[10] == "l7\nl8\nl9\nl10"


# --- tables ----------------------------------------------------------------------------------


def test_table_maintenance(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 3), ("c", 3)], "id string, v int")
    assert [tuple(r) for r in tables.insert_ignore(frame, new).collect()] == [("c", 3)]
    assert sorted(map(tuple, tables.replace_by_key(frame, new.limit(1)).collect())) == [("a", 1), ("b", 9)]
    updated = tables.update_by_key(frame.withColumn("done", F.lit(False)), spark.createDataFrame([("a", None)], "id string, v int"),
                                   "id", ["v"], "done")
    assert sorted(map(tuple, updated.collect())) == [("a", None, True), ("b", 2, False)]
    assert {r.id: r.done for r in tables.mark(frame.withColumn("done", F.lit(False)), new, "id", "done").collect()} == {
        "a": False, "b": True}
    latest = tables.last_per_key(spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "id string, v int, seq int"), "id", "seq")
    assert latest.first().v == 2
    assert tables.unique_violations(new, "id").first().id == "c"


def test_upsert_keeps_managed_columns(spark):
    old = spark.createDataFrame([repo("1", score=20, framework="flask")], REPO).withColumn("filtered", F.lit(True))
    new = spark.createDataFrame([repo("1", stars=9, score=0), repo("2", stars=8)], REPO)
    rows = {r.id: (r.stars, r.score, r.framework, r.filtered) for r in tables.upsert_repositories(old, new).collect()}
    assert rows == {"1": (9, 20, "flask", True), "2": (8, 0, None, False)}


def test_cascade_and_work_lists(spark):
    repos = spark.createDataFrame([repo("1"), repo("2")], REPO)
    found = spark.createDataFrame([finding("a"), finding("b", repo="2"), finding("c", repo="7")], FINDING)
    kept, rest = tables.delete_by_ids(repos, spark.createDataFrame([("1",)], "id string"), found)
    assert ids(kept) == ["2"] and ids(rest) == ["b", "c"]
    assert ids(tables.orphans(found, repos, "repository_id")) == ["c"]
    done = found.where("repository_id = '2'")
    assert ids(tables.not_done(found, done, "repository_id")) == ["a", "c"]
    assert ids(tables.not_done(found, done, "repository_id", force=True)) == ["a", "b", "c"]
    assert ids(tables.already_done(found, done, "repository_id")) == ["b"]


def test_decode(spark):
    rows = spark.createDataFrame([("1", "n", "u", "3", "php", "bad", "1", 1, None, "0")],
                                 "id string, name string, url string, stars string, language string, last_push string, "
                                 "size_mb string, archived int, framework string, score string")
    row = records.decode_repositories(rows).first()
    assert (row.stars, row.last_push, row.archived) == (3, datetime(1970, 1, 1), True)
    clones = spark.createDataFrame([("1", "/c", "2024-01-01T00:00:00", 0)],
                                   "repository_id string, local_path string, clone_timestamp string, scanned int")
    assert records.decode_local_repositories(clones).first().scanned is False


# --- scanner events --------------------------------------------------------------------------


def test_scanner_events(spark):
    def match(path, line, text="code\n"):
        return json.dumps({"type": "match", "data": {"path": {"text": path}, "lines": {"text": text}, "line_number": line,
                                                     "absolute_offset": 0, "submatches": []}})

    lines = ["", "  ", "not json", json.dumps({"type": "begin", "data": {}}), json.dumps({"type": "summary", "data": {}}),
             match("/tmp/r/1/src/app.php", 17, "exec($x);\n"), match("/other/a.php", 1), *[match("/tmp/r/1/b.php", i) for i in range(5)]]
    for root in ("/tmp/r/1", "/tmp/r/1/"):
        events = spark.createDataFrame([(x, "r1", root, "p1") for x in lines],
                                       "value string, repository_id string, repo_root string, pattern_id string")
        patterns = spark.createDataFrame([("p1", "ssrf")], "id string, vulnerability_type string")
        rows = records.scanner_findings(events, patterns).collect()
        assert sorted({r.file_path for r in rows}) == ["/other/a.php", "b.php", "src/app.php"]
        assert len(rows) == len({r.id for r in rows}) == 7
        hit = next(r for r in rows if r.line_number == 17)
        assert (hit.snippet, hit.vulnerability_type) == ("exec($x);", "ssrf")
    assert records.scanner_findings(events.where("false"), patterns).count() == 0


# --- date windows ----------------------------------------------------------------------------


def bisect(counts, a, b, cap):
    n = sum(v for d, v in counts.items() if a <= d <= b)
    if n == 0:
        return []
    days = (b - a).days
    if n <= cap or days < 2:
        return [(a, b, n)]
    mid = a + timedelta(days=days // 2)
    return bisect(counts, a, mid - timedelta(days=1), cap) + bisect(counts, mid, b, cap)


@pytest.mark.parametrize("seed,days,cap", [(1, 400, 20), (2, 3, 5), (3, 2, 1), (4, 1, 1), (5, 1000, 7), (6, 64, 10_000)])
def test_capped_windows(spark, seed, days, cap):
    rng, start = random.Random(seed), date(2023, 1, 1)
    counts = {start + timedelta(days=rng.randrange(days)): rng.randrange(1, 15) for _ in range(min(days, 120))}
    counts[start] = cap * 2
    rows = [(datetime(d.year, d.month, d.day, 13),) for d, n in counts.items() for _ in range(n)]
    rows.append((datetime(2030, 1, 1),))
    frame, end = spark.createDataFrame(rows, "t timestamp"), start + timedelta(days=days - 1)
    expected = bisect(counts, start, end, cap)
    got = windows.capped_windows(frame, "t", start, end, cap).collect()
    assert [(r.window_start, r.window_end, r.row_count) for r in got] == expected
    assert [r.over_cap for r in got] == [n > cap for _, _, n in expected]
    spread = windows.assign_windows(frame, "t", start, end, cap).groupBy("window_start").count().collect()
    assert {r.window_start: r["count"] for r in spread} == {a: n for a, _, n in expected}


def test_search_queries(spark):
    spans = spark.createDataFrame([(date(2023, 1, 1), date(2023, 2, 1))], "window_start date, window_end date")
    rows = discovery.search_queries(spans, ["php"], min_stars=5).collect()
    assert [r.query for r in rows] == ["stars:>5 fork:false archived:false pushed:2023-01-01..2023-02-01 language:php"]


# --- static analysis -------------------------------------------------------------------------


def flaw(i, cwe="89", severity=5, path="src/a.py", line=2):
    out = {"issue_id": i, "cwe_id": cwe, "issue_type": "t", "files": {"source_file": {"file": path, "line": line}}}
    return {**out, "severity": severity} if severity is not None else out


@pytest.fixture
def results(spark, tmp_path):
    def put(project, name, value):
        folder = tmp_path / project / ".pkg"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(value if isinstance(value, str) else json.dumps(value))

    put("app", "filtered_a.json", {"findings": [flaw(i, severity=3 + i % 3, cwe="78" if i % 2 else "9" if i % 10 == 0 else "89")
                                                for i in range(61 + 7)]})
    put("app", "filtered_b.json", {"findings": [flaw(900, severity=None), flaw(901, path="\\pkg\\src\\a.py"), flaw(902, path=""),
                                                flaw(903, path="no/where.py"), flaw(904, cwe="117")]})
    put("web", "filtered_c.json", "{broken")
    put("web", "filtered_d.json", {"other": 1})
    put("web", "filtered_e.json", {"findings": [flaw(1, severity=4)]})
    put("web", "other.json", {"findings": [flaw(2)]})
    return records.read_sast_results(spark, str(tmp_path), ".pkg")


def test_sast(spark, results, tmp_path):
    rows = sast.flaws(results)
    assert rows.where("repo = 'web'").count() == 1
    fit = sast.qualifying(rows)
    expected = [(r.repo, r.severity or 0, int(r.cwe_id), r.scan_file, r.pos, r.issue_id) for r in fit.collect()]
    app = sorted((e for e in expected if e[0] == "app"), key=lambda e: (-e[1], e[2], e[3], e[4]))
    top = sast.top_per_repository(fit).where("repo = 'app'").orderBy("rank").collect()
    assert [r.issue_id for r in top] == [e[5] for e in app[:60]]
    counts = {r.repo: (r.total_qualifying, r.assessed_count, r.capped) for r in sast.repository_counts(fit).collect()}
    assert counts == {"app": (len(app), 60, True), "web": (1, 1, False)}
    report = spark.createDataFrame([("7", "web", "u", "", 3, 1, ["xss"], "/c/7")], schemas.REPO_REPORT)
    projects = sast.summary(rows, report)
    got = {r.project: (r.repository_name, r.repository_url, r.finding_count) for r in projects.collect()}
    assert got["web"] == ("web", "u", 1)
    assert got["app"][:2] == ("app", None) and got["app"][2] == sast.high_severity(rows).where("repo = 'app'").count()
    assert sast.summary_findings(rows, projects).count() == sum(v[2] for v in got.values())
    assert sast.summary(rows).count() == 2
    assert ids(sast.triage_targets(rows), "repo") == ["app", "web"]
    sinks.write_high_severity_summary(projects, sast.summary_findings(rows, projects), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out" / "projects")).count() == 2


def test_excerpts_are_cut_where_they_stay(spark):
    """One row per flaw, whatever is repeated or null; the path as it is comes first; no excerpt is shuffled."""
    files = spark.createDataFrame(
        [("app", "a.py", "python", "one\ntwo"), ("app", "a.py", "python", "one\ntwo"), ("app", "pkg/a.py", "python", "three"),
         ("app", "b.py", "python", None), (None, "a.py", "python", "four")], schemas.SOURCE_FILES)
    flaws = spark.createDataFrame(
        [(1, "app", "/a.py", 1), (2, "app", "pkg/a.py", 1), (3, "app", "gone/a.py", 2), (3, "app", "gone/a.py", 2),
         (4, "app", "b.py", 1), (5, None, "a.py", 1), (6, "app", None, None), (7, "app", "", 3), (8, None, None, 1)],
        "n int, repo string, file string, line int")
    found = context.attach_excerpt(flaws, files)
    one, two = "    1 >>> one\n    2     two", "    1     one\n    2 >>> two"
    want = [(1, one), (2, "    1 >>> three"), (3, two), (3, two), (4, "[source file not found: b.py]"),
            (5, "[source file not found: a.py]"), *[(n, "[no source path]") for n in (6, 7, 8)]]
    assert sorted((r.n, r.source_excerpt) for r in found.collect()) == want
    moved = None
    for line in found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines():
        depth = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        moved = None if moved is not None and depth <= moved else moved
        if moved is None and "Exchange hashpartitioning" in line:
            moved = depth
        assert moved is None or "lpad(" not in line


def test_sast_excerpts_and_documents(spark, results, tmp_path):
    files = spark.createDataFrame([("app", "src/a.py", "python", "one\ntwo\nthree")], schemas.SOURCE_FILES)
    rows = {r.issue_id: r.source_excerpt for r in context.attach_excerpt(sast.qualifying(sast.flaws(results)), files).collect()
            if r.repo == "app"}
    shown = "    1     one\n    2 >>> two\n    3     three"
    assert rows[1] == rows[901] == shown
    assert rows[902] == "[no source path]" and rows[903] == "[source file not found: no/where.py]"
    docs = {r.repo: r for r in sast_plan.documents(results, files).collect()}
    assert len(docs["app"].findings) == 60 and docs["app"].capped and docs["app"].findings[0]["source_excerpt"] == shown
    assert docs["web"].findings[0]["source_excerpt"] == "[source file not found: src/a.py]"
    sinks.write_combined_results(sast_plan.documents(results, files), str(tmp_path / "docs"))
    assert spark.read.json(str(tmp_path / "docs" / "repository=web")).first().total_qualifying == 1


def test_triage_verdicts(spark):
    rows = [("a", 1, 4, "needs_review"), ("a", 2, 5, "false_positive"), ("b", 3, 5, "exploitable"), ("b", 4, 5, "other")]
    frame = spark.createDataFrame(rows, "repo string, issue_id bigint, severity int, verdict string")
    merged = sast.triage_merge(frame.where("repo = 'a'"), frame.where("repo = 'b'"))
    assert [r.issue_id for r in merged.collect()] == [3, 2, 4, 1]
    total = sast.triage_summary(frame).first()
    assert (total.repos_assessed, total.total_findings, total.exploitable, total.needs_review) == (2, 4, 1, 1)
    assert {r.repo: r.exploitable for r in sast.verdict_pivot(frame).collect()} == {"a": 0, "b": 1}


# --- export and whole runs -------------------------------------------------------------------


def test_export(spark):
    rows = [("1", "app", "u", "", 9, 2, ["xss"], ""), ("2", "app", "u", "", 9, 1, ["xss"], ""), ("3", "app", "u", "", 5, 9, ["xss"], ""),
            ("4", "lib", "u", "", 5, 1, ["xss"], ""), ("5", "new", "u", "", 1, 1, ["xss"], "")]
    report = spark.createDataFrame(rows, schemas.REPO_REPORT)
    assert ids(export.export_select(report, 5, 2), "repository_id") == ["1", "3"]
    assert export.export_select(report).count() == 5
    clones = spark.createDataFrame([("2",), ("3",), ("4",), ("5",)], "repository_id string")
    there = spark.createDataFrame([("lib",)], "export_name string")
    plan = {r.repository_id: (r.export_name, r.outcome) for r in export.export_plan(report, clones, there, 2).collect()}
    assert plan == {"1": (None, "skipped_missing"), "2": ("app", "exported"), "3": ("app_3", "exported"), "4": ("lib", "skipped_exists")}


def test_triage_and_reports(spark, tmp_path):
    files = spark.createDataFrame(
        [("1", "controllers/a.py", "python", "x\neval(request)\ny\n"), ("1", "vendor/b.py", "python", "eval(request)"),
         ("2", "c.py", "python", "eval(request)"), ("3", "d.py", "python", "eval(")], schemas.SOURCE_FILES)
    repos = spark.createDataFrame([repo("1", stars=600), repo("2", archived=True), repo("3", language="php")], REPO).drop("score")
    signals = spark.createDataFrame([("1", "django")], "repository_id string, value string")
    rules = [Rule("ev", "e", r"eval\(", "command_injection", 9), Rule("rq", "r", "request", "xss", 2)]
    queue = triage_plan.triage(files, repos, rules, NOW, signals=signals)
    rows = {r.repository_id: r for r in queue.collect()}
    assert set(rows) == {"1", "3"}
    one = rows["1"]
    assert (one.repo_score, one.finding_score, one.combined_score) == (5 + 4 + 8 + 6, 10 + 3 + 2, 23 + 15)
    assert one.snippet == "x\neval(request)\ny" and one.matched_pattern_ids == ["ev", "rq"] and one.framework == "django"
    # The long way round gives the same: score with the repositories first, then de-duplicate and join.
    prepared = triage_plan.prepare_repositories(repos, NOW, signals=signals, files=files)
    slow = findings.review_queue(findings.deduplicate(findings.score_findings(
        triage_plan.scan_repositories(files, prepared, rules), prepared)), prepared)
    assert sorted(map(str, queue.collect())) == sorted(map(str, slow.select(queue.columns).collect()))
    done = spark.createDataFrame([("1",)], "repository_id string")
    assert ids(triage_plan.scan_repositories(files, prepared, rules, done=done), "repository_id") == ["3"]
    only = triage_plan.prepare_repositories(repos, NOW, triage_plan.Settings(language="php"))
    assert ids(only) == ["3"]
    sinks.write_findings_report(findings.ranked(queue), str(tmp_path / "f"))
    assert spark.read.json(str(tmp_path / "f")).count() == 2
    report = findings.repository_report(findings.deduplicate(findings.score_findings(
        triage_plan.scan_repositories(files, prepared, rules), prepared)), prepared)
    sinks.write_repo_report(report, str(tmp_path / "r"), "/clones")
    back = records.read_repo_report(spark, str(tmp_path / "r"))
    assert {r.repository_id: r.local_path for r in back.collect()} == {"1": "/clones/1", "3": "/clones/3"}
    (tmp_path / "array.json").write_text('[{"repository_name": "a"}, {"repository_name": ""}, {"repository_id": "3"}]')
    assert ids(records.read_repo_report(spark, str(tmp_path / "array.json"), array=True), "repository_name") == ["a"]
    sinks.write_triage_report(spark.range(1), str(tmp_path / "t"))


def test_one_row_per_result_file_carries_counts_and_first_flaws(spark):
    import random

    rng = random.Random(3)
    schema = ("project string, scan_file string, findings array<struct<issue_id:bigint, cwe_id:string, issue_type:string, "
              "severity:int, files:struct<source_file:struct<file:string, line:int>>, display_text:string, flaw_details:string, "
              "description:string, cwename:string, stack_dumps:string>>")

    def flaw(i):
        where = rng.choice([None, ((rng.choice([None, "a/b.py"]), rng.choice([None, 3])),)])
        return (i, rng.choice(["89", "79", "117", None, "x"]), rng.choice([None, "t"]), rng.choice([None, 0, 3, 4, 5]), where, *[None] * 5)

    rows = [(rng.choice(["p", "q"]), f"s{k}", [flaw(100 * k + i) for i in range(rng.choice([0, 1, 5, 80]))]) for k in range(30)]
    rows += [("none", "s", None), ("none", "t", [])]
    results = spark.createDataFrame(rows, schema).repartition(4)
    files = sast.per_file(results, cap=7)
    plain = sast.qualifying(sast.flaws(results))
    assert files.selectExpr("max(size(top))").first()[0] == 7
    columns = ["repo", "rank", "issue_id", "scan_file", "pos", "cwe_id", "issue_type", "severity", "file", "line"]
    got = sast.top_per_repository(sast.flaws_of(files), 7).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, sast.top_per_repository(plain, 7).select(*columns).collect()), key=str)
    assert sorted(sast.counts_of(files, 7).collect()) == sorted(sast.repository_counts(plain, 7).collect())
    high = {r.repo: r.n for r in files.groupBy("repo").agg(F.sum("high").alias("n")).collect()}
    want = {r.repo: r["count"] for r in sast.high_severity(sast.flaws(results)).groupBy("repo").count().collect()}
    assert {k: n for k, n in high.items() if n} == want
