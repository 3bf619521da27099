import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from codesieve import constants as C
from codesieve.functions import identity, paths, scoring, text, values


@pytest.mark.parametrize("key", ["r:src/a.py:3:p", "", "ünïcode:ß:1:x", "日本:1"])
def test_uuid5_equals_library(evaluate, key):
    expected = str(uuid.uuid5(uuid.UUID(C.FINDING_NAMESPACE), key))
    assert evaluate(identity.uuid5(F.col("x")), row=(key,)) == expected


@pytest.mark.parametrize("path,ignored", [
    ("src/a.js", False), ("node_modules/a.js", True), ("x/node_modules/y/a.js", True), ("my_node_modules/a.js", False),
    ("vendor", True), ("App.Tests/a.cs", True), ("x/App.Tests.Unit/a.cs", True), ("AppXTests/a.cs", False),
    ("spec/a.rb", True), ("special/a.rb", False), ("tests/x.py", True),
])
def test_ignored(evaluate, path, ignored):
    assert evaluate(paths.is_ignored(F.col("x"), C.IGNORED_PATHS_WITH_TESTS), row=(path,)) is ignored


def test_glob_with_slash_and_empty(evaluate):
    assert evaluate(paths.is_ignored(F.col("x"), ["src/gen"]), row=("src/gen/a.py",)) is True
    assert evaluate(paths.is_ignored(F.col("x"), ["src/gen"]), row=("x/src/gen/a.py",)) is False
    assert evaluate(paths.is_ignored(F.col("x"), []), row=("vendor/a",)) is False
    assert evaluate(paths.is_hidden(F.col("x")), row=(".git/config",)) is True
    assert evaluate(paths.is_hidden(F.col("x")), row=("a/b.py",)) is False


@pytest.mark.parametrize("path,language", [
    ("a.php", "php"), ("a/b.PHTML", "php"), ("a.pyi", "python"), ("x.vue", "javascript"), ("x.mts", "typescript"),
    ("x.jsp", "java"), ("x.cs", "csharp"), ("Makefile", None), ("a.b/c", None), ("x.css", None),
])
def test_language_of(evaluate, path, language):
    assert evaluate(paths.language_of(F.col("x")), row=(path,)) == language


@pytest.mark.parametrize("path,root,expected", [
    ("/tmp/r/1/src/a.php", "/tmp/r/1", "src/a.php"), ("/tmp/r/1/src/a.php", "/tmp/r/1/", "src/a.php"),
    ("/other/a.php", "/tmp/r/1", "/other/a.php"), ("/tmp/r/12/a.php", "/tmp/r/1", "/tmp/r/12/a.php"),
])
def test_relativize(evaluate, path, root, expected):
    assert evaluate(paths.relativize(F.col("p"), F.col("r")), "p string, r string", (path, root)) == expected


@pytest.mark.parametrize("url,path,root,expected", [
    ("https://h/o/r", "src/app/Foo.java", None, "https://h/o/r/blob/HEAD/src/app/Foo.java#L7"),
    ("https://h/o/r", "e:\\temp\\12\\src\\Foo.java", "e:\\temp\\12", "https://h/o/r/blob/HEAD/src/Foo.java#L7"),
    ("https://h/o/r", "E:\\temp\\12\\src\\Foo.java", "e:\\temp\\12\\", "https://h/o/r/blob/HEAD/src/Foo.java#L7"),
    ("https://h/o/r", "e:\\temp\\12\\Foo.java", "e:\\other", "https://h/o/r/blob/HEAD/temp/12/Foo.java#L7"),
    ("https://h/o/r", "e:\\temp\\12\\Foo.java", None, "https://h/o/r/blob/HEAD/temp/12/Foo.java#L7"),
    ("https://h/o/r", "/clones/1/a.py", "/clones/1", "https://h/o/r/blob/HEAD/a.py#L7"),
    ("https://h/o/r", "/clones/12/a.py", "/clones/1", "https://h/o/r/blob/HEAD/clones/12/a.py#L7"),
    ("https://h/o/r", "./a//b.py", None, "https://h/o/r/blob/HEAD/a/b.py#L7"),
    (None, "a.py", None, None), ("", "a.py", None, None), ("https://h/o/r", "", None, None),
])
def test_blob_url(evaluate, url, path, root, expected):
    column = paths.blob_url(F.col("u"), F.col("p"), F.lit(7), F.col("r"))
    assert evaluate(column, "u string, p string, r string", (url, path, root)) == expected


def test_owner_and_repo(evaluate):
    assert tuple(evaluate(paths.owner_and_repo(F.col("x")), row=("https://h/own/rep/",))) == ("own", "rep")
    assert evaluate(paths.path_tags(F.col("x")), row=("src/API/admin/Reset.php",)) == ["account_recovery", "api", "sensitive_area"]


TEN = "\n".join(f"line {i}" for i in range(1, 11))


@pytest.mark.parametrize("content,line,expected", [
    (TEN, 1, "line 1\nline 2\nline 3\nline 4"), (TEN, 5, "\n".join(f"line {i}" for i in range(2, 9))),
    (TEN, 10, "line 7\nline 8\nline 9\nline 10"), (TEN + "\n", 10, "line 7\nline 8\nline 9\nline 10"),
    ("only", 1, "only"), (None, 1, ""), ("", 1, ""), ("a\r\nb\r\nc", 2, "a\nb\nc"), ("a\u2028b\nc", 2, "a\u2028b\nc"),
    ("a\nb", 9, ""),
])
def test_context_snippet(evaluate, content, line, expected):
    assert evaluate(text.context_snippet(F.col("x"), F.lit(line)), row=(content,)) == expected


def test_lines_and_excerpt(evaluate):
    assert evaluate(text.lines(F.col("x")), row=("a\n\nb\n",)) == ["a", "", "b"]
    assert evaluate(text.lines(F.col("x")), row=("",)) == []
    excerpt = evaluate(text.source_excerpt(F.col("x"), F.lit(2), 1), row=("a\nb\r\nc\nd",))
    assert excerpt == "    1     a\n    2 >>> b\n    3     c"


@pytest.mark.parametrize("kind,path,repo,expected", [
    ("command_injection", "a.py", 0, 10), ("deserialization", "a.py", 0, 9), ("file_inclusion", "a", 0, 8),
    ("path_traversal", "a", 0, 8), ("sql_injection", "a", 0, 7), ("ssrf", "a", 0, 6), ("xss", "a", 0, 3),
    ("os_command_injection", "a", 0, 0), ("xss", "app/controllers/a", 0, 6), ("xss", "routes/a", 0, 6),
    ("xss", "routes/controllers/a", 0, 9), ("xss", "Controllers/A.cs", 0, 6), ("xss", "a", 9, 3), ("xss", "a", 10, 4),
    ("xss", "a", 33, 6), ("xss", "a", 105, 13), ("xss", "a", None, 3),
])
def test_finding_score(evaluate, kind, path, repo, expected):
    column = scoring.finding_score(F.col("k"), F.col("p"), F.col("r"))
    assert evaluate(column, "k string, p string, r int", (kind, path, repo)) == expected


def test_finding_score_case_sensitive(evaluate):
    assert evaluate(scoring.finding_score(F.lit("xss"), F.col("x"), None, True), row=("Controllers/A.cs",)) == 3


NOW = datetime(2025, 6, 1)


@pytest.mark.parametrize("stars,age,framework,controllers,expected", [
    (0, 365, None, False, 0), (500, 365, None, False, 0), (501, 365, None, False, 5), (2000, 365, None, False, 5),
    (2001, 365, None, False, 15), (0, 30, None, False, 4), (0, 180, None, False, 0), (0, 179.9, None, False, 4),
    (0, 365, "", False, 0), (0, 365, "django", False, 8), (0, 365, None, True, 6), (5000, 1, "flask", True, 33),
])
def test_repository_score(evaluate, stars, age, framework, controllers, expected):
    column = scoring.repository_score(F.col("s"), F.col("t"), F.col("f"), F.col("c"), NOW)
    row = (stars, NOW - timedelta(days=age), framework, controllers)
    assert evaluate(column, "s int, t timestamp, f string, c boolean", row) == expected


@pytest.mark.parametrize("name,expected", [("C#", "csharp"), ("JavaScript", "javascript"), ("Go", "go"), ("", "php"), (None, "php")])
def test_language(evaluate, name, expected):
    assert evaluate(values.normalize_language(F.col("x"), "PHP"), row=(name,)) == expected


def test_other_values(evaluate):
    assert [evaluate(values.size_mb(F.col("x")), "x bigint", (kb,)) for kb in (None, 0, 1023, 2048, 10_485_760)] == [1, 1, 1, 2, 10240]
    assert evaluate(values.timestamp_or_epoch(F.col("x")), row=("2024-01-15T10:30:00Z",)) == datetime(2024, 1, 15, 10, 30)
    assert evaluate(values.timestamp_or_epoch(F.col("x")), row=("soon",)) == datetime(1970, 1, 1)
    assert evaluate(values.string_list(F.col("x")), row=('["a"]',)) == ["a"]
    assert evaluate(values.string_list(F.col("x")), row=("[a",)) == []
    assert evaluate(values.string_list(F.col("x")), row=(None,)) == []
    assert evaluate(values.pattern_language(F.col("x")), row=("TypeScript",)) == "javascript"
    assert values.pushed_qualifier("2023-01-01") == "pushed:>2023-01-01"


@pytest.mark.parametrize("before,expected", [
    (None, "stars:>7 fork:false archived:false pushed:>2023-01-01 language:java"),
    ("2024-01-01", "stars:>7 fork:false archived:false pushed:2023-01-01..2024-01-01 language:java"),
])
def test_query_text(evaluate, before, expected):
    column = values.query_text(F.lit(C.SEARCH_TEMPLATES[0]), F.lit("java"), F.lit(7), F.lit("2023-01-01"), F.col("x"))
    assert evaluate(column, row=(before,)) == expected
