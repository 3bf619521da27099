"""The driver's tables seen as our tables.

Each text runs in Spark and in DuckDB alike; ``{name}`` stands for an input table or another view.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from codesieve.operators.search import Search
from codesieve.packs import builtin_rules
from codesieve.sources.rules import Rule
from codesieve.sources.tables import read_table

AS_OF = datetime(2001, 8, 2)

# Text-hygiene pack; without backslashes, word boundaries and look-around so that every engine reads it alike.
HYGIENE = [
    Rule("hyg_token", "hex token", 'token *= *"[0-9a-f]{40}"', "command_injection", 10),
    Rule("hyg_email", "e-mail address", "[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+[.][A-Za-z]+", "path_traversal", 7),
    Rule("hyg_ipv4", "IPv4 address", "(^|[^0-9.])([0-9]{1,3}[.]){3}[0-9]{1,3}([^0-9.]|$)", "ssrf", 6),
    Rule("hyg_license", "license line", "[Rr]eleased under the [A-Za-z0-9.-]+ [Ll]icense", "xss", 3),
    Rule("hyg_digits", "long digit run", "(^|[^0-9])[0-9]{13,16}([^0-9]|$)", "weak_crypto", 5),
]
# A match that runs over a line end: a line of one word and the first word of the next line.
MULTILINE = [Rule("ml_break", "sentence over two lines", "[a-z]+[.] *\n[A-Z][a-z]+ [a-z]+", "xss", 3)]

# Any white space may lie between the two sentences, a line end too; it is not asked for.
ACROSS = [Rule("ml_across", "sentences that follow", "[a-z]+[.]\\s+[A-Z][a-z]+ [a-z]+", "xss", 3)]

# Searches over prose: with languages, paths to leave out, popularity, and texts taken literally.
SEARCHES = {
    "numbers": Search("[0-9]{3,}", language="en", without_paths=("vendor", "routes"), min_stars=100),
    "long_word": Search("[a-z]{18,}"), "shout": Search("[A-Z]{4,}", min_stars=5000), "mail": Search("@", quoted=True),
    "license": Search("Licensed|License", without_paths=("controllers",)), "dollar": Search("$", quoted=True),
    "brackets": Search("[a-z][(]", language="fr"), "price": Search("[0-9]+[.][0-9]{2}"),
    "question": Search("?", quoted=True, language="de"), "same": Search("the the ", language="en"),
    "end": Search("[.]$", language="es", without_paths=("src/f",)), "url": Search("https?://[a-z]+"),
}

# Built-in rules as far as an engine without look-ahead can check them.
PACK = [rule for rule in builtin_rules() if "(?!" not in rule.regex]

VIEWS: dict[str, str] = {
    "code_files": """
        SELECT source AS repository_id, 'src/f' || CAST(doc_id AS STRING) AS file_path,
               CASE lang WHEN 'en' THEN 'php' WHEN 'fr' THEN 'python' WHEN 'de' THEN 'java' ELSE 'csharp' END AS language,
               replace(text, '. ', CASE lang WHEN 'en' THEN ' ; eval($_GET["x"]) ; echo md5($_POST["y"]) ; '
                                   WHEN 'fr' THEN ' os.system(request.args["x"]) ; hashlib.md5(data) ; '
                                   WHEN 'de' THEN ' run.exec(getParameter("c")) ; in.readObject() ; '
                                   ELSE ' Redirect(Request.Query["u"]) ; Path.Combine(root, name) ; ' END) AS content
        FROM {documents}""",
    "repositories": """
        SELECT 'src' || CAST(c.c_custkey AS STRING) AS id,
               lower(c.c_name) || CASE c.c_custkey % 11 WHEN 3 THEN '-demo' WHEN 7 THEN '-Tutorial' ELSE '' END AS name,
               'https://example.test/o' || CAST(c.c_nationkey AS STRING) || '/r' || CAST(c.c_custkey AS STRING) AS url,
               CAST(floor(greatest(c.c_acctbal, 0)) AS INT) AS stars,
               CASE c.c_mktsegment WHEN 'BUILDING' THEN 'en' WHEN 'FURNITURE' THEN 'fr' WHEN 'MACHINERY' THEN 'de'
                                   WHEN 'HOUSEHOLD' THEN 'es' ELSE 'en' END AS language,
               o.last_push AS last_push,
               CAST(coalesce(o.n, 0) * 15 AS INT) AS size_mb,
               c.c_custkey % 17 = 5 AS archived,
               CASE WHEN c.c_custkey % 3 = 0 THEN 'express' ELSE '' END AS framework
        FROM {customer} c LEFT JOIN
             (SELECT o_custkey, max(o_orderdate) AS last_push, count(*) AS n FROM {orders} GROUP BY o_custkey) o
          ON o.o_custkey = c.c_custkey""",
    "source_files": """
        SELECT source AS repository_id, lang AS language, text AS content,
               CASE doc_id % 6 WHEN 0 THEN 'src/controllers/' WHEN 1 THEN 'src/routes/' WHEN 2 THEN 'vendor/lib/'
                               WHEN 3 THEN 'App/Controllers/' WHEN 4 THEN 'controllers/' ELSE 'src/' END
               || 'f' || CAST(doc_id AS STRING) || '.' || lang AS file_path
        FROM {documents}""",
    "local_repositories": """
        SELECT source AS repository_id, '/clones/' || source AS local_path, min(doc_id) % 2 = 0 AS scanned
        FROM {documents} GROUP BY source""",
    "patterns": """
        SELECT 'p' || CAST(p_partkey AS STRING) AS id, p_name AS name, replace(p_name, ' ', '.*') AS regex,
               CASE p_size % 5 WHEN 0 THEN 'xss' WHEN 1 THEN 'ssrf' WHEN 2 THEN 'sql_injection'
                               WHEN 3 THEN 'deserialization' ELSE 'weak_crypto' END AS vulnerability_type,
               p_size AS severity_score, lower(p_type) AS language,
               'CWE-' || CAST(CAST(p_size % 9 AS INT) AS STRING) AS cwe, p_type AS cwe_name
        FROM {part}""",
    "flaw_rows": """
        SELECT coalesce(d.source, 'lib' || CAST(l.l_suppkey % 7 AS STRING)) AS repo,
               'filtered_' || CAST(l.l_orderkey AS STRING) || '.json' AS scan_file,
               l.l_linenumber AS n, l.l_orderkey * 10 + l.l_linenumber AS issue_id,
               CASE l.l_suppkey % 12 WHEN 0 THEN '22' WHEN 1 THEN '78' WHEN 2 THEN '79' WHEN 3 THEN '80'
                    WHEN 4 THEN '89' WHEN 5 THEN '327' WHEN 6 THEN '502' WHEN 7 THEN '611' WHEN 8 THEN '918'
                    WHEN 9 THEN '73' WHEN 10 THEN '200' ELSE '117' END AS cwe_id,
               'issue ' || CAST(l.l_suppkey % 12 AS STRING) AS issue_type,
               CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN NULL
                    ELSE CAST(floor(l.l_quantity) AS INT) % 6 END AS severity,
               CASE WHEN d.doc_id IS NULL THEN '' ELSE
                 CASE l.l_linenumber WHEN 2 THEN '/' WHEN 3 THEN 'root/' WHEN 5 THEN 'gone/away/' ELSE '' END ||
                 CASE d.doc_id % 6 WHEN 0 THEN 'src/controllers/' WHEN 1 THEN 'src/routes/' WHEN 2 THEN 'vendor/lib/'
                               WHEN 3 THEN 'App/Controllers/' WHEN 4 THEN 'controllers/' ELSE 'src/' END
                 || 'f' || CAST(d.doc_id AS STRING) || '.' || d.lang END AS file,
               CAST(l.l_suppkey % 40 AS INT) AS line
        FROM {lineitem} l LEFT JOIN {documents} d ON d.doc_id = l.l_partkey""",
    "verdicts": """
        SELECT repo, issue_id, cwe_id, issue_type, coalesce(severity, 0) AS severity, file, line, n,
               CASE n WHEN 1 THEN 'exploitable' WHEN 2 THEN 'likely_exploitable' WHEN 3 THEN 'needs_review'
                      WHEN 4 THEN 'unlikely_exploitable' ELSE 'false_positive' END AS verdict
        FROM {flaw_rows}""",
}

# Text-heavy or costly to expand, and stored as one row group.
INPUTS = ("customer", "orders", "documents", "part", "lineitem", "pages", "events", "conversations", "nation")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or one of the views."""
    if name not in VIEWS:
        return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    text = VIEWS[name]
    inputs = {ref: table(spark, sf_dir, ref) for ref in (*INPUTS, *VIEWS) if "{" + ref + "}" in text}
    return spark.sql(text, **inputs)


def view_ctes(*names: str) -> str:
    """The views (and what they build on) as DuckDB common table expressions."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        for ref in VIEWS:
            if ref != name and "{" + ref + "}" in VIEWS[name]:
                add(ref)
        text = VIEWS[name]
        for ref in (*INPUTS, *VIEWS):
            text = text.replace("{" + ref + "}", ref)
        parts.setdefault(name, text.replace("AS STRING)", "AS VARCHAR)"))

    for name in names:
        add(name)
    return ", ".join(f"{name} AS ({text})" for name, text in parts.items())


def _re2(regex: str) -> str:
    """The regex with a look-behind written as the equivalent choice of text start or character."""
    return regex.replace(r"(?<![\w$])", r"(?:^|[^\w$])")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rules_values(rules: list[Rule]) -> str:
    """Rules as a DuckDB relation."""
    rows = ", ".join(
        f"({', '.join(map(_quoted, (r.id, _re2(r.regex), r.vulnerability_type, r.language)))}, {r.severity_score})"
        for r in rules)
    return f"(SELECT * FROM (VALUES {rows}) AS t(id, regex, vulnerability_type, language, severity_score))"


def rule_selects(rules: list[Rule]) -> list[str]:
    """One DuckDB query per rule over ``lines``; constant regexes are compiled once."""
    return [f"SELECT repository_id, file_path, line_number, {_quoted(r.id)} AS rule FROM lines "
            f"WHERE language = {_quoted(r.language)} AND regexp_matches(line, {_quoted(_re2(r.regex))})" for r in rules]
