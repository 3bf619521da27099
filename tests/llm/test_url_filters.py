import pytest

from codesieve.llm import url_filters
from codesieve.llm.queries import URL_RULES
from codesieve.llm.url_filters import UrlRule


@pytest.fixture
def pages(spark):
    def make(*urls):
        return spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(urls)],
                                     "page_id long, url string, rule string, verdict string").repartition(3)
    return make


def verdicts(df, rules=URL_RULES, **options):
    return [tuple(r)[1:] for r in sorted(url_filters.judge(df, rules, **options).collect(), key=lambda r: r.page_id)]


def test_contract_cases(pages):
    got = verdicts(pages(
        "http://WWW.Example.com/en/a?x", "https://a.example.com/en/", "http://example.com/En/", "http://b.net/fr/x#y",
        "http://net/es/", "http://badexample.com/en/", "http://x.com", None, "no scheme", "", "x://y.net/fr",
        "a://b://c.com/d", "http://a.b.c.com?q=/", "http://www.example.com/en/a?x"))
    assert got == [
        ("www.example.com", "/en/a", "www.example.com/en/", "allow"), ("a.example.com", "/en/", "example.com/en/", "block"),
        ("example.com", "/En/", "com/", "allow"), ("b.net", "/fr/x", "net/fr/", "block"), ("net", "/es/", "net/es/", "block"),
        ("badexample.com", "/en/", "com/", "allow"), ("x.com", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("y.net", "/fr", None, "allow"), ("b:", "//c.com/d", None, "allow"),
        ("a.b.c.com", "", None, "allow"), ("www.example.com", "/en/a", "www.example.com/en/", "allow")]


def test_wildcards_open_ends_and_default(pages):
    rules = [UrlRule("s.org", "/a*z", "block"), UrlRule("s.org", "/ab", "allow"), UrlRule("org", "/q.html", "drop")]
    got = verdicts(pages("http://s.org/a1/2z3", "http://s.org/abc", "http://t.org/qxhtml", "http://t.org/q.html5"),
                   rules, default="none")
    assert [g[2:] for g in got] == [("s.org/a*z", "block"), ("s.org/ab", "allow"), (None, "none"), ("org/q.html", "drop")]


def test_rules_are_filed_under_their_rarest_token(spark, pages):
    df = pages(*["http://a.com/en/"] * 3, "http://b.com/x", "http://example.com/y")
    urls = df.select(url_filters.host_of(df.url).alias("_host"), url_filters.path_of(df.url).alias("_path"))
    rules = [UrlRule("example.com", "/en/", "block"), UrlRule("com", "/", "allow"), UrlRule("o", "/u*", "x")]
    index = url_filters.index_rules(url_filters.url_tokens(urls), url_filters.rule_table(spark, rules))
    assert {r.rule: r._token for r in index.collect()} == {"example.com/en/": "example", "com/": "com", "o/u*": "o"}


def test_rule_without_a_token(pages):
    assert verdicts(pages("http://h.x/-/"), [UrlRule("-", "/", "block"), UrlRule("h.x", "/-", "b")]) == [
        ("h.x", "/-/", "h.x/-", "b")]


def test_empty_null_ids_and_clashing_rules(spark, pages):
    assert verdicts(pages("x").limit(0)) == []
    df = spark.createDataFrame([(None, "http://a.net/es/")] * 2, "page_id long, url string")
    assert [r.verdict for r in url_filters.judge(df, URL_RULES).collect()] == ["block", "block"]
    with pytest.raises(ValueError):
        url_filters.judge(df, [UrlRule("a", "/", "x"), UrlRule("A", "/", "y")])


def test_only_dataframe_functions(pages):
    plan = url_filters.judge(pages("http://a.com/"), URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
