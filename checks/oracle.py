"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from checks.views import ACROSS, HYGIENE, PACK, SEARCHES, _quoted, rule_selects, rules_values, view_ctes

NS = "6ba7b8109dad11d180b400c04fd430c8"
IGNORED = "(^|/)(node_modules|vendor|dist|build|target|migrations)(/|$)"
AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"


def uuid5(key: str) -> str:
    h = f"sha1(unhex('{NS}') || encode({key}))"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
            f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 3) || '-' || "
            f"substr({h}, 21, 12)")


FINDING_ID = uuid5("l.repository_id || ':' || l.file_path || ':' || CAST(l.line_number AS VARCHAR) || ':' || p.id")

LINES = f"""
eligible AS (SELECT * FROM source_files WHERE NOT regexp_matches(file_path, '{IGNORED}')),
split AS (SELECT repository_id, file_path, language, content, string_split(content, chr(10)) AS a,
                 len(string_split(content, chr(10)))
                 - CASE WHEN content = '' OR content LIKE '%' || chr(10) THEN 1 ELSE 0 END AS n FROM eligible),
lines AS (SELECT repository_id, file_path, language, a, n, CAST(i AS INTEGER) AS line_number, a[i] AS line
          FROM split, unnest(range(1, n + 1)) AS t(i))"""

RAW = f"""{LINES},
patterns_used AS {rules_values(HYGIENE)},
raw AS (SELECT {FINDING_ID} AS id, l.repository_id, l.file_path, l.line_number, p.id AS pattern_id,
               p.vulnerability_type, l.line AS snippet, 0 AS score, l.language, l.a, l.n
        FROM lines l JOIN patterns_used p ON regexp_matches(l.line, p.regex))"""

BASE = """CASE vulnerability_type WHEN 'command_injection' THEN 10 WHEN 'deserialization' THEN 9
          WHEN 'file_inclusion' THEN 8 WHEN 'path_traversal' THEN 8 WHEN 'sql_injection' THEN 7 WHEN 'ssrf' THEN 6
          WHEN 'xss' THEN 3 ELSE 0 END
          + CASE WHEN file_path ILIKE '%controllers/%' THEN 3 ELSE 0 END
          + CASE WHEN file_path ILIKE '%routes/%' THEN 3 ELSE 0 END"""


def repo_score(controllers: str) -> str:
    return f"""CASE WHEN stars > 500 THEN 5 ELSE 0 END + CASE WHEN stars > 2000 THEN 10 ELSE 0 END
               + CASE WHEN last_push > {AS_OF} - INTERVAL 180 DAY THEN 4 ELSE 0 END
               + CASE WHEN framework <> '' THEN 8 ELSE 0 END + {controllers}"""


REPOS = f"""
scored_repos AS (SELECT r.*, CAST({repo_score("CASE WHEN id IN (SELECT repository_id FROM source_files WHERE file_path LIKE 'controllers/%') THEN 6 ELSE 0 END")} AS INTEGER) AS score
                 FROM repositories r)"""

SCORED = f"""{RAW}, {REPOS},
scored AS (SELECT f.* EXCLUDE (score), CAST({BASE} + coalesce(r.score // 10, 0) AS INTEGER) AS score
           FROM raw f LEFT JOIN scored_repos r ON r.id = f.repository_id)"""

WINNERS = f"""{SCORED},
ranked AS (SELECT *, row_number() OVER (PARTITION BY repository_id, file_path, line_number
                                        ORDER BY score DESC, id) AS rn FROM scored),
ids AS (SELECT repository_id, file_path, line_number, count(*) AS n, string_agg(DISTINCT pattern_id, ',' ORDER BY pattern_id) AS pattern_ids
        FROM scored GROUP BY ALL),
best AS (SELECT w.id, w.repository_id, w.file_path, w.line_number, w.pattern_id, w.vulnerability_type, w.snippet, w.score,
                CASE WHEN i.n > 1 THEN i.pattern_ids ELSE '' END AS matched_pattern_ids
         FROM ranked w JOIN ids i USING (repository_id, file_path, line_number) WHERE w.rn = 1)"""

QUEUE = f"""{WINNERS},
queue AS (SELECT f.id AS finding_id, f.repository_id, f.pattern_id, r.name AS repository_name, r.url AS repository_url,
                 r.framework, f.file_path, f.line_number, f.vulnerability_type, f.snippet, f.matched_pattern_ids,
                 f.score AS finding_score, r.score AS repo_score, f.score + r.score AS combined_score
          FROM best f JOIN scored_repos r ON r.id = f.repository_id)"""

REPORT = f"""{SCORED},
report AS (SELECT r.id AS repository_id, r.name AS repository_name, r.url AS repository_url,
                  coalesce(r.framework, '') AS framework, max(f.score) AS top_score, count(*) AS finding_count,
                  string_agg(DISTINCT f.vulnerability_type, ',' ORDER BY f.vulnerability_type) AS vulnerability_types,
                  '/clones/' || r.id AS local_path, r.language
           FROM scored f JOIN scored_repos r ON r.id = f.repository_id WHERE f.score >= 1
           GROUP BY r.id, r.name, r.url, r.framework, r.language)"""

KEEP = """NOT archived AND stars >= 100 AND size_mb <= 200
          AND NOT regexp_matches(lower(name), 'tutorial|example|demo|practice|cheatsheet|awesome-')"""

PLAIN = "id, repository_id, file_path, line_number, pattern_id, vulnerability_type, snippet, score"

FLAWS = """
flaws AS (SELECT repo, scan_file, CAST(row_number() OVER (PARTITION BY repo, scan_file ORDER BY n, issue_id, cwe_id,
                 issue_type, severity NULLS FIRST, file, line) - 1 AS INTEGER) AS pos,
                 issue_id, cwe_id, issue_type, severity, file, line FROM flaw_rows),
fit AS (SELECT * FROM flaws WHERE cwe_id IN ('22', '78', '79', '80', '89', '327', '502', '611', '918')),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY repo ORDER BY coalesce(severity, 0) DESC,
                 CAST(cwe_id AS INTEGER), scan_file, pos) AS INTEGER) AS rank FROM fit) WHERE rank <= 60),
counts AS (SELECT repo, count(*) AS total_qualifying, least(count(*), 60) AS assessed_count, count(*) > 60 AS capped
           FROM fit GROUP BY repo)"""


def excerpt(rows: str) -> str:
    """CTEs that cut the excerpt of the flaws in ``rows`` into ``cut``."""
    return f"""
paths AS (SELECT DISTINCT repo, file, line, ltrim(replace(file, '\\', '/'), '/') AS p FROM {rows}),
tried AS (SELECT repo, file, line, 0 AS t, p AS file_path FROM paths
          UNION ALL SELECT repo, file, line, 1, regexp_replace(p, '^[^/]*/', '') FROM paths WHERE p LIKE '%/%'),
texts AS (SELECT repository_id, file_path, string_split(content, chr(10)) AS a,
                 len(string_split(content, chr(10)))
                 - CASE WHEN content = '' OR content LIKE '%' || chr(10) THEN 1 ELSE 0 END AS n FROM source_files),
hit AS (SELECT t.*, x.a, x.n, row_number() OVER (PARTITION BY t.repo, t.file, t.line ORDER BY t.t) AS rn
        FROM tried t JOIN texts x ON x.repository_id = t.repo AND x.file_path = t.file_path),
cut AS (SELECT repo, file, line, coalesce(array_to_string(list_transform(
               range(greatest(1, line - 8), least(n, line + 8) + 1),
               lambda i: lpad(CAST(i AS VARCHAR), 5, ' ') || ' ' || CASE WHEN i = line THEN '>>>' ELSE '   ' END || ' ' || a[i]),
               chr(10)), '') AS txt FROM hit WHERE rn = 1)"""


EXCERPT_TEXT = """CASE WHEN f.file = '' THEN '[no source path]'
                  ELSE coalesce(c.txt, '[source file not found: ' || f.file || ']') END AS source_excerpt"""

SNIPPET = """array_to_string(list_slice(a, greatest(1, line_number - 3), least(n, line_number + 3)), chr(10))"""

EXT = "CASE language WHEN 'en' THEN '.PHP' WHEN 'fr' THEN '.tsx' WHEN 'de' THEN '.py' ELSE '' END"
EXT_LANG = "CASE language WHEN 'en' THEN 'php' WHEN 'fr' THEN 'typescript' WHEN 'de' THEN 'python' END"
STEM = "regexp_replace(file_path, '[.][a-z]+$', '')"
SIGNALS = """
words AS (SELECT 'src' || CAST(conv_id AS VARCHAR) AS repository_id, unnest(string_split(text, ' ')) AS value FROM conversations),
marks AS (SELECT repository_id, CASE right(repository_id, 1) WHEN '1' THEN 'composer.json' WHEN '2' THEN 'Startup.cs'
                 WHEN '3' THEN 'my-Django-app' END AS value FROM words),
signals AS (SELECT * FROM words UNION ALL SELECT * FROM marks WHERE value IS NOT NULL
            UNION ALL SELECT repository_id, 'artisan' FROM marks WHERE repository_id LIKE '%11')"""
LABELS = [("laravel", "artisan|laravel"), ("symfony", "symfony"), ("express", "express"), ("koa", "koa"),
          ("fastify", "fastify"), ("nestjs", "nestjs|@nestjs"), ("django", "django"), ("flask", "flask"),
          ("fastapi", "fastapi"), ("spring", "spring-boot|spring-web"),
          ("aspnetcore", "microsoft[.]aspnetcore|startup[.]cs|program[.]cs"), ("php", "composer[.]json")]
FRAMEWORK = "CASE " + " ".join(f"WHEN regexp_matches(s, '{rx}') THEN '{label}'" for label, rx in LABELS) + " ELSE '' END"

WINDOWS = """
w AS (SELECT DATE '1995-01-01' AS a, DATE '2001-12-31' AS b, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE)
             BETWEEN DATE '1995-01-01' AND DATE '2001-12-31') AS c
      UNION ALL
      SELECT h.a, h.b, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN h.a AND h.b)
      FROM (SELECT w.a AS a, w.a + CAST((w.b - w.a) // 2 AS INTEGER) - 1 AS b FROM w WHERE w.c > 400 AND w.b - w.a >= 2
            UNION ALL
            SELECT w.a + CAST((w.b - w.a) // 2 AS INTEGER) AS a, w.b AS b FROM w WHERE w.c > 400 AND w.b - w.a >= 2) h),
spans AS (SELECT a AS window_start, b AS window_end, c AS row_count, c > 400 AS over_cap FROM w
          WHERE c > 0 AND (c <= 400 OR b - a < 2))"""

PARTS = """
raw_entries AS (SELECT 'packs/' || p_brand || '.json' AS source_file, lower(p_brand) AS language, p_partkey AS k,
       'p' || CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
       CASE WHEN p_partkey % 9 = 4 THEN '[' || p_name ELSE p_name END AS regex, lower(p_type) AS vulnerability_type,
       CASE WHEN p_partkey % 7 = 2 THEN NULL ELSE p_size END AS severity_score FROM part),
checked AS (SELECT source_file, CASE WHEN k % 11 = 3 THEN NULL ELSE id END AS id,
       CASE WHEN k % 11 = 3 OR k % 8 = 5 THEN NULL ELSE name END AS name,
       CASE WHEN k % 11 = 3 THEN NULL ELSE regex END AS regex,
       CASE WHEN k % 11 = 3 THEN NULL ELSE vulnerability_type END AS vulnerability_type,
       CASE WHEN k % 11 = 3 THEN NULL ELSE severity_score END AS severity_score, language, 'CWE-1' AS cwe, '' AS cwe_name,
       CASE WHEN k % 11 = 3 THEN 'not_a_mapping' WHEN k % 8 = 5 THEN 'missing_fields'
            WHEN severity_score IS NULL THEN 'bad_severity_score' WHEN k % 9 = 4 THEN 'bad_regex' ELSE 'valid' END AS reason
       FROM raw_entries)"""

F, R, L, P, V, T = "source_files", "repositories", "local_repositories", "patterns", "flaw_rows", "verdicts"


def _with(views: tuple[str, ...], ctes: str, body: str, recursive: bool = False) -> str:
    parts = [p for p in (view_ctes(*views) if views else "", ctes.strip()) if p]
    head = "WITH " + ("RECURSIVE " if recursive else "")
    return (head + ",\n".join(parts) + "\n" if parts else "") + body


EVENT_ROOT = "'/clones/' || repository_id"
EVENT_PATH = "CASE WHEN language = 'es' THEN '/other/' || file_path ELSE '/clones/' || repository_id || '/' || file_path END"
EVENT_REL = "CASE WHEN language = 'es' THEN '/other/' || file_path ELSE file_path END"

ORACLE: dict[str, str] = {
    "pattern_validate": _with((), PARTS, "SELECT * FROM checked"),
    "pattern_pack_stats": _with((), PARTS, """SELECT source_file, count(*) FILTER (reason = 'valid') AS loaded,
        count(*) FILTER (reason <> 'valid') AS skipped FROM checked GROUP BY source_file"""),
    "source_files_scan": _with((F,), "", """SELECT repository_id, file_path, language, CAST(length(content) AS INTEGER) AS n_chars,
        CAST(len(string_split(content, chr(10))) - CASE WHEN content = '' OR content LIKE '%' || chr(10) THEN 1 ELSE 0 END AS INTEGER) AS n_lines
        FROM source_files"""),
    "match_events_parse": _with((F,), "", f"""SELECT {uuid5(f"repository_id || ':' || {EVENT_REL} || ':' || CAST(length(content) AS VARCHAR) || ':ev'")} AS id,
        repository_id, {EVENT_REL} AS file_path, CAST(length(content) AS INTEGER) AS line_number, 'ev' AS pattern_id,
        'xss' AS vulnerability_type, rtrim(content, chr(10)) AS snippet, 0 AS score
        FROM source_files WHERE file_path NOT LIKE 'vendor%' AND file_path NOT LIKE 'App%'"""),
    "repo_nodes_normalize": _with((R,), "", """SELECT substr(id, 4) AS id, name, url, stars,
        CASE language WHEN 'en' THEN 'csharp' WHEN 'fr' THEN 'javascript' ELSE 'php' END AS language,
        CAST(last_push AS DATE) AS last_push, CAST(greatest(1, size_mb * 100 // 1024) AS INTEGER) AS size_mb, archived
        FROM repositories WHERE size_mb > 0"""),
    "repos_scan": _with((R,), "", "SELECT id, name, stars, size_mb FROM repositories WHERE language = 'en' AND stars > 1000"),
    "decode_defaults": _with((R,), "", """SELECT id, stars, CASE WHEN archived OR last_push IS NULL THEN DATE '1970-01-01'
        ELSE CAST(last_push AS DATE) END AS last_push, size_mb, archived, 0 AS score,
        CASE WHEN language = 'fr' THEN 2 ELSE 0 END AS n_patterns FROM repositories"""),
    "sast_read": _with((V,), FLAWS, "SELECT repo, scan_file, pos, issue_id, cwe_id, issue_type, severity, file, line FROM flaws"),
    "findings_insert_ignore": _with((F,), RAW, f"SELECT {PLAIN} FROM raw WHERE vulnerability_type NOT IN ('ssrf', 'xss')"),
    "repos_upsert": _with((F, R), REPOS, """SELECT id, name, url, CASE WHEN stars < 5000 THEN stars + 7 ELSE stars END AS stars,
        language, CAST(last_push AS DATE) AS last_push, size_mb, archived,
        CASE WHEN stars > 500 THEN framework END AS framework, CASE WHEN stars > 500 THEN score ELSE 0 END AS score,
        stars > 500 AS scored FROM scored_repos WHERE stars > 500 OR stars < 5000"""),
    "patterns_upsert": _with((P,), "", """SELECT id, CASE WHEN severity_score >= 20 THEN upper(name) ELSE name END AS name, regex,
        vulnerability_type, severity_score, language, cwe, cwe_name FROM patterns"""),
    "update_by_key": _with((R,), SIGNALS, """SELECT r.id, CASE WHEN u.v IS NULL THEN r.framework ELSE u.v END AS framework,
        u.v IS NOT NULL AS framework_detected FROM repositories r
        LEFT JOIN (SELECT repository_id, max(value) AS v FROM signals GROUP BY repository_id) u ON u.repository_id = r.id"""),
    "cascade_delete": _with((F, R, L), f"{RAW}, gone AS (SELECT id FROM repositories WHERE NOT ({KEEP}))", """
        SELECT 'repositories' AS table_name, id AS row_key FROM repositories WHERE id NOT IN (SELECT id FROM gone)
        UNION ALL SELECT 'local_repositories', repository_id FROM local_repositories WHERE repository_id NOT IN (SELECT id FROM gone)
        UNION ALL SELECT 'findings', id FROM raw WHERE repository_id NOT IN (SELECT id FROM gone)"""),
    "repo_filter": _with((R,), "", f"SELECT id, name, stars, size_mb FROM repositories WHERE {KEEP}"),
    "repo_filter_stats": _with((R,), "", """SELECT CASE WHEN archived THEN 'archived' WHEN stars < 100 THEN 'stars'
        WHEN size_mb > 200 THEN 'size'
        WHEN regexp_matches(lower(name), 'tutorial|example|demo|practice|cheatsheet|awesome-') THEN 'name'
        ELSE 'kept' END AS outcome, count(*) AS n FROM repositories GROUP BY 1"""),
    "lookup_by_id": _with((R,), "", "SELECT id, name, url, stars FROM repositories WHERE id = 'src7'"),
    "already_present": _with((R, L), "", """SELECT id AS repository_id, name FROM repositories
        WHERE id IN (SELECT repository_id FROM local_repositories)"""),
    "pending_work": _with((R, L), "", """SELECT id AS repository_id, name FROM repositories
        WHERE id NOT IN (SELECT repository_id FROM local_repositories)"""),
    "local_by_language": _with((R, L), "", """SELECT l.*, 'all' AS kind FROM local_repositories l JOIN repositories r
        ON r.id = l.repository_id WHERE r.language = 'en'
        UNION ALL SELECT l.*, 'unscanned' FROM local_repositories l JOIN repositories r ON r.id = l.repository_id
        WHERE r.language = 'en' AND NOT l.scanned"""),
    "patterns_by_language": _with((P,), "", "SELECT id, name, severity_score FROM patterns WHERE language = 'economy'"),
    "patterns_by_cwe": _with((P,), "", "SELECT id, name, severity_score FROM patterns WHERE cwe = 'CWE-4'"),
    "patterns_ordered": _with((P,), "", "SELECT id, language, severity_score FROM patterns"),
    "findings_by_repo": _with((F, R), SCORED, "SELECT id, file_path, line_number, score FROM scored WHERE repository_id = 'src3'"),
    "ignored_paths": _with((F,), "", f"""SELECT repository_id, file_path, regexp_matches(file_path, '{IGNORED}') AS ignored,
        regexp_matches(file_path, '(^|/)([^/]*[.]en|App)(/|$)') AS ignored_by_glob FROM source_files"""),
    "file_type_filter": _with((F,), "", f"""SELECT repository_id, {STEM} || {EXT} AS file_path, {EXT_LANG} AS file_language
        FROM source_files WHERE {EXT_LANG} IS NOT NULL"""),
    "language_alias": _with((F,), "", f"""SELECT repository_id, {STEM} || {EXT} AS file_path,
        CASE language WHEN 'en' THEN 'php' WHEN 'fr' THEN 'javascript' WHEN 'de' THEN 'python' END AS pattern_language
        FROM source_files"""),
    "relativize_path": _with((F,), "", f"SELECT repository_id, {EVENT_PATH} AS path, {EVENT_REL} AS relative FROM source_files"),
    "code_search": _with((F, R), """lines AS (SELECT repository_id, file_path, a[i] AS line, CAST(i AS INTEGER) AS line_number
        FROM (SELECT repository_id, file_path, string_split(content, chr(10)) AS a FROM source_files WHERE language = 'en'
              AND lower(file_path) NOT LIKE '%vendor%' AND lower(file_path) NOT LIKE '%routes%') s,
             unnest(range(1, len(a) + 1)) AS t(i))""", """SELECT repository_id, file_path, line_number, line, '' AS path_tags
        FROM lines WHERE regexp_matches(line, '[0-9]{3,}')
        AND repository_id IN (SELECT id FROM repositories WHERE stars > 100)"""),
    "code_searches": _with((F, R), """lines AS (SELECT repository_id, file_path, language, a[i] AS line, CAST(i AS INTEGER) AS line_number
        FROM (SELECT repository_id, file_path, language, string_split(content, chr(10)) AS a FROM source_files) s,
             unnest(range(1, len(a) + 1)) AS t(i))""", " UNION ALL ".join(
        f"SELECT '{name}' AS search, repository_id, file_path, line_number, line FROM lines WHERE "
        + (f"contains(line, '{s.regex}')" if s.quoted else f"regexp_matches(line, '{s.regex}')")
        + (f" AND language = '{s.language}'" if s.language else "")
        + "".join(f" AND lower(file_path) NOT LIKE '%{word}%'" for word in s.without_paths)
        + (f" AND repository_id IN (SELECT id FROM repositories WHERE stars > {s.min_stars})" if s.min_stars is not None else "")
        for name, s in SEARCHES.items())),
    "path_tags": """SELECT page_id, url, concat_ws(',',
        CASE WHEN regexp_matches(lower(url), 'reset|forgot|password') THEN 'account_recovery' END,
        CASE WHEN regexp_matches(lower(url), 'api') THEN 'api' END,
        CASE WHEN regexp_matches(lower(url), 'upload|import|backup') THEN 'file_exchange' END,
        CASE WHEN regexp_matches(lower(url), 'admin|internal|debug|test|dev') THEN 'sensitive_area' END) AS tags FROM pages""",
    "regex_scan": _with((F,), RAW, f"SELECT {PLAIN} FROM raw"),
    "rule_pack_scan": _with(("code_files",), LINES.replace("source_files", "code_files").replace(
        "lines AS (", "lines AS MATERIALIZED (") + f""",
        hits AS ({" UNION ALL ".join(rule_selects(PACK))})""", f"""SELECT {FINDING_ID} AS id, l.repository_id, l.file_path, l.line_number,
        p.id AS pattern_id, p.vulnerability_type, 0 AS score
        FROM hits l, (SELECT id, vulnerability_type FROM {rules_values(PACK)}) p WHERE p.id = l.rule"""),
    "regex_scan_multiline": _with((F,), f"""
        eligible AS (SELECT * FROM source_files WHERE NOT regexp_matches(file_path, '{IGNORED}')),
        parts AS (SELECT repository_id, file_path, string_split(content, chr(10)) AS a, string_split(regexp_replace(content,
                  '[a-z]+[.] *' || chr(10) || '[A-Z][a-z]+ [a-z]+', chr(1) || '\\0' || chr(2), 'g'), chr(1)) AS p FROM eligible),
        pieces AS (SELECT repository_id, file_path, a, i, p[i] AS piece,
                   length(p[i]) - length(replace(p[i], chr(10), '')) AS nl FROM parts, unnest(range(1, len(p) + 1)) AS t(i)),
        spans AS (SELECT repository_id, file_path, a, i, 1 + coalesce(sum(nl) OVER (PARTITION BY repository_id, file_path ORDER BY i
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first,
                  string_split(piece, chr(2))[1] AS matched FROM pieces),
        l AS (SELECT repository_id, file_path, CAST(first AS INTEGER) AS line_number, array_to_string(list_slice(a, CAST(first AS INTEGER),
              CAST(first + max(length(matched) - length(replace(matched, chr(10), ''))) AS INTEGER)), chr(10)) AS snippet
              FROM spans WHERE i > 1 GROUP BY repository_id, file_path, a, first),
        p AS (SELECT 'ml_break' AS id)""", f"""SELECT {FINDING_ID} AS id, l.repository_id, l.file_path, l.line_number,
        'ml_break' AS pattern_id, 'xss' AS vulnerability_type, l.snippet, 0 AS score FROM l, p"""),
    "merge_adjacent": _with((F,), f"""{LINES}, m AS (SELECT repository_id, file_path, line_number,
        line_number - row_number() OVER (PARTITION BY repository_id, file_path ORDER BY line_number) AS g
        FROM lines WHERE regexp_matches(line, '[a-z]+ing '))""", """SELECT repository_id, file_path, 'adj' AS pattern_id,
        min(line_number) AS line_number, max(line_number) AS end_line, count(*) AS line_count FROM m GROUP BY repository_id, file_path, g"""),
    "finding_id": _with((F,), "", f"""SELECT repository_id, file_path, {uuid5("repository_id || ':' || file_path || ':' || CAST(length(content) AS VARCHAR) || ':' || substring(content, 1, 40)")} AS id
        FROM source_files"""),
    "score_findings": _with((F, R), SCORED, "SELECT id, file_path, vulnerability_type, score FROM scored"),
    "dedup_findings": _with((F, R), WINNERS, "SELECT * FROM best"),
    "dedup_window": _with((F, R), WINNERS, "SELECT id, repository_id, file_path, line_number, score FROM best"),
    "dedup_losers": _with((F, R), WINNERS, "SELECT id, repository_id, file_path, line_number, score FROM ranked WHERE rn > 1"),
    "dedup_stats": _with((F, R), WINNERS, """SELECT (SELECT count(*) FROM scored) AS rows_before, (SELECT count(*) FROM best) AS rows_after,
        (SELECT count(*) FROM ranked WHERE rn > 1) AS rows_removed"""),
    "duplicate_locations": _with((F, R), WINNERS, """SELECT repository_id, file_path, line_number, i.n, i.pattern_ids, b.id AS winner_id
        FROM ids i JOIN best b USING (repository_id, file_path, line_number) WHERE i.n > 1"""),
    "distinct_locations": _with((F,), RAW, "SELECT DISTINCT repository_id, file_path, line_number FROM raw"),
    "findings_by_language": _with((F, R), RAW, """SELECT id, repository_id FROM raw
        WHERE repository_id IN (SELECT id FROM repositories WHERE language = 'en')"""),
    "pending_by_language": _with((F, R), RAW, """SELECT id, repository_id, vulnerability_type FROM raw WHERE vulnerability_type <> 'ssrf'
        AND repository_id IN (SELECT id FROM repositories WHERE language = 'en')"""),
    "count_unscored": _with((F, R), RAW, """SELECT count(*) AS n, 'all' AS kind FROM raw WHERE vulnerability_type <> 'ssrf'
        UNION ALL SELECT count(*), 'en' FROM raw WHERE vulnerability_type <> 'ssrf'
        AND repository_id IN (SELECT id FROM repositories WHERE language = 'en')"""),
    "review_queue": _with((F, R), QUEUE, "SELECT * FROM queue"),
    "review_queue_full": _with((F, R, L), QUEUE, """SELECT q.finding_id, q.repository_name, q.framework, q.file_path, q.line_number, l.local_path,
        q.repository_url || '/blob/HEAD/' || q.file_path || '#L' || CAST(q.line_number AS VARCHAR) AS github_url, q.combined_score
        FROM queue q JOIN repositories r ON r.id = q.repository_id AND r.language = 'en'
        LEFT JOIN local_repositories l ON l.repository_id = q.repository_id"""),
    "review_queue_top": _with((F, R), QUEUE, """SELECT finding_id, repository_id, finding_score, repo_score, combined_score FROM queue
        ORDER BY combined_score DESC, finding_id LIMIT 25"""),
    "repo_report": _with((F, R), REPORT, "SELECT * EXCLUDE (language) FROM report"),
    "category_priority": _with((F, R), SCORED, """SELECT id, vulnerability_type, CASE vulnerability_type WHEN 'command_injection' THEN 1
        WHEN 'path_traversal' THEN 3 WHEN 'ssrf' THEN 5 WHEN 'xss' THEN 6 ELSE 7 END AS category_rank, score FROM scored"""),
    "orphan_findings": _with((F, R), RAW, f"""SELECT id, repository_id FROM raw
        WHERE repository_id NOT IN (SELECT id FROM repositories WHERE {KEEP})"""),
    "orphan_patterns": _with((F,), RAW, f"SELECT id, pattern_id FROM raw WHERE pattern_id = '{HYGIENE[0].id}'"),
    "unique_violations": "SELECT md5(text) AS text_md5, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1",
    "context_snippet": _with((F,), RAW, f"SELECT id, {SNIPPET} AS snippet FROM raw"),
    "context_join": _with((F,), RAW, f"""SELECT id, CASE WHEN repository_id = 'src2' THEN snippet WHEN file_path LIKE 'App%' THEN ''
        ELSE {SNIPPET} END AS snippet FROM raw"""),
    "context_window": _with((F,), """split AS (SELECT repository_id, file_path, string_split(content, chr(10)) AS a,
        len(string_split(content, chr(10))) - CASE WHEN content = '' OR content LIKE '%' || chr(10) THEN 1 ELSE 0 END AS n FROM source_files)""",
        f"""SELECT repository_id, file_path, line_number, {SNIPPET} AS snippet
        FROM (SELECT *, CAST(i AS INTEGER) AS line_number FROM split, unnest(range(1, n + 1)) AS t(i))"""),
    "source_excerpt": _with((V, F), FLAWS + "," + excerpt("fit"), f"""SELECT f.repo, f.scan_file, f.pos, f.file, f.line, {EXCERPT_TEXT}
        FROM fit f LEFT JOIN cut c ON c.repo = f.repo AND c.file = f.file AND c.line = f.line"""),
    "framework_detect": _with((R,), SIGNALS, f"""SELECT r.id, coalesce(d.framework, '') AS framework FROM repositories r LEFT JOIN
        (SELECT repository_id, {FRAMEWORK} AS framework FROM (SELECT repository_id, lower(string_agg(value, ' ')) AS s
         FROM signals GROUP BY repository_id)) d ON d.repository_id = r.id"""),
    "repo_score": _with((F, R), REPOS, "SELECT id, stars, framework, score FROM scored_repos"),
    "repo_score_first_run": _with((R,), "", f"SELECT id, CAST({repo_score('0')} AS INTEGER) AS score FROM repositories"),
    "repos_by_score": _with((F, R), REPOS, "SELECT id, score FROM scored_repos"),
    "owner_repo": """SELECT page_id, p[-2] AS owner, p[-1] AS repo FROM
        (SELECT page_id, string_split(rtrim(url, '/'), '/') AS p FROM pages)""",
    "blob_url": _with((F,), "", """SELECT repository_id, path, CASE WHEN repository_id <> 'src1' THEN
        'https://example.test/' || repository_id || '/blob/HEAD/' || rel || '#L' || CAST(n AS VARCHAR) END AS blob
        FROM (SELECT repository_id, length(content) AS n,
              CASE language WHEN 'fr' THEN 'E:\\clones\\' || repository_id || '\\' || replace(file_path, '/', '\\')
                   WHEN 'de' THEN '/clones/' || repository_id || '/' || file_path
                   WHEN 'es' THEN '/elsewhere/' || file_path ELSE file_path END AS path,
              CASE language WHEN 'es' THEN 'elsewhere/' || file_path ELSE file_path END AS rel FROM source_files)"""),
    "language_normalize": """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'csharp' WHEN 'FURNITURE' THEN 'typescript'
        WHEN 'MACHINERY' THEN 'typescript' ELSE lower(c_mktsegment) END AS language FROM customer""",
    "size_mb": """SELECT o_orderkey, CAST(greatest(1, coalesce(CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END, 0) // 1024) AS INTEGER)
        AS size_mb FROM orders""",
    "query_templates": _with((), WINDOWS, """SELECT language, CAST(window_start AS VARCHAR) AS after, CAST(window_end AS VARCHAR) AS before,
        'stars:>100 fork:false archived:false pushed:' || CAST(window_start AS VARCHAR) || '..' || CAST(window_end AS VARCHAR) || ' language:' || language AS query
        FROM spans, (SELECT unnest(['php', 'javascript', 'typescript', 'python', 'java', 'csharp']) AS language)""", True),
    "capped_windows": _with((), WINDOWS, "SELECT * FROM spans", True),
    "window_assign": _with((), WINDOWS, """SELECT o_orderkey, window_start, window_end FROM orders JOIN spans
        ON CAST(o_orderdate AS DATE) BETWEEN window_start AND window_end""", True),
    "sast_qualifying": _with((V,), FLAWS, "SELECT repo, issue_id, cwe_id, severity FROM fit"),
    "sast_top_n": _with((V,), FLAWS, "SELECT repo, rank, severity, cwe_id, scan_file, pos, issue_id FROM top"),
    "sast_counts": _with((V,), FLAWS, "SELECT * FROM counts"),
    "sast_summary": _with((V, F, R), REPORT + "," + FLAWS, """SELECT f.repo AS project, f.repo AS repository_name, r.repository_url, r.local_path,
        count(*) AS finding_count FROM flaws f LEFT JOIN report r ON r.repository_id = f.repo
        WHERE coalesce(f.severity, 0) >= 4 GROUP BY f.repo, r.repository_url, r.local_path"""),
    "sast_summary_findings": _with((V, F, R), REPORT + "," + FLAWS, """SELECT f.repo AS project, coalesce(r.repository_name, f.repo) AS repository_name, f.issue_id,
        f.cwe_id, f.severity FROM flaws f LEFT JOIN report r ON r.repository_name = f.repo WHERE coalesce(f.severity, 0) >= 4"""),
    "sast_combined": _with((V,), FLAWS, """SELECT repo, c.total_qualifying, c.assessed_count, c.capped,
        (SELECT string_agg(CAST(t.issue_id AS VARCHAR), ',' ORDER BY t.rank) FROM top t WHERE t.repo = c.repo) AS issue_ids FROM counts c"""),
    "sast_end_to_end": _with((V, F), FLAWS + "," + excerpt("top"), f"""SELECT f.repo, f.rank, f.issue_id, f.cwe_id, f.severity, {EXCERPT_TEXT},
        k.total_qualifying, k.capped FROM top f JOIN counts k ON k.repo = f.repo
        LEFT JOIN cut c ON c.repo = f.repo AND c.file = f.file AND c.line = f.line"""),
    "sast_documents": _with((V, F), FLAWS + "," + excerpt("top"), f"""SELECT f.repo, k.total_qualifying, k.assessed_count, k.capped,
        f.rank AS place, f.rank, f.issue_id, f.scan_file, f.cwe_id, f.issue_type, f.severity, f.file, f.line, {EXCERPT_TEXT}
        FROM top f JOIN counts k ON k.repo = f.repo
        LEFT JOIN cut c ON c.repo = f.repo AND c.file = f.file AND c.line = f.line"""),
    "triage_targets": _with((V,), "", """SELECT DISTINCT repo FROM flaw_rows
        WHERE cwe_id IN ('73', '78', '80', '89', '327', '502', '611', '918')"""),
    "triage_merge": _with((T,), "", "SELECT repo, issue_id, severity, verdict FROM verdicts"),
    "triage_summary": _with((T,), "", """SELECT count(DISTINCT repo) AS repos_assessed, count(*) AS total_findings,
        count(*) FILTER (verdict = 'exploitable') AS exploitable, count(*) FILTER (verdict = 'likely_exploitable') AS likely_exploitable,
        count(*) FILTER (verdict = 'needs_review') AS needs_review,
        count(*) FILTER (verdict = 'unlikely_exploitable') AS unlikely_exploitable,
        count(*) FILTER (verdict = 'false_positive') AS false_positive FROM verdicts"""),
    "triage_pivot": _with((T,), "", """SELECT repo,
        count(*) FILTER (verdict = 'exploitable') AS exploitable, count(*) FILTER (verdict = 'likely_exploitable') AS likely_exploitable,
        count(*) FILTER (verdict = 'needs_review') AS needs_review,
        count(*) FILTER (verdict = 'unlikely_exploitable') AS unlikely_exploitable,
        count(*) FILTER (verdict = 'false_positive') AS false_positive FROM verdicts GROUP BY repo"""),
    "export_select": _with((F, R), REPORT, """SELECT repository_id, top_score, finding_count FROM report
        WHERE top_score >= 9 AND finding_count >= 2"""),
    "export_names": _with((F, R), REPORT, """SELECT repository_id, language AS repository_name, CASE WHEN row_number() OVER
        (PARTITION BY language ORDER BY top_score DESC, finding_count DESC, repository_id) = 1 THEN language
        ELSE language || '_' || repository_id END AS export_name FROM report"""),
    "export_plan": _with((F, R, L), f"""{REPORT}, here AS (SELECT *, repository_id IN (SELECT repository_id FROM local_repositories
        WHERE repository_id <> 'src4') AS present FROM report),
        named AS (SELECT repository_id, language AS repository_name, present, CASE WHEN NOT present THEN NULL WHEN row_number() OVER
        (PARTITION BY language, present ORDER BY top_score DESC, finding_count DESC, repository_id) = 1 THEN language
        ELSE language || '_' || repository_id END AS export_name FROM here)""", """SELECT repository_id, repository_name, export_name,
        CASE WHEN NOT present THEN 'skipped_missing' WHEN export_name IN (SELECT language FROM repositories WHERE stars > 3000)
        THEN 'skipped_exists' ELSE 'exported' END AS outcome FROM named"""),
    "incremental_scan": _with((F, R, L), RAW, f"""SELECT id, repository_id, file_path, line_number, pattern_id FROM raw
        WHERE repository_id NOT IN (SELECT repository_id FROM local_repositories WHERE scanned)
        AND repository_id IN (SELECT id FROM repositories WHERE {KEEP})"""),
    "triage_end_to_end": _with((F, R), QUEUE, f"""SELECT finding_id, repository_id, pattern_id, repository_name, repository_url, framework,
        file_path, line_number, vulnerability_type, (SELECT {SNIPPET} FROM raw w WHERE w.id = q.finding_id) AS snippet,
        matched_pattern_ids, finding_score, repo_score, combined_score
        FROM queue q WHERE repository_id IN (SELECT id FROM repositories WHERE {KEEP})"""),
}

# Stored files give what plain ones give.
ORACLE["context_stored"] = ORACLE["context_join"]
ORACLE["incremental_stored"] = ORACLE["incremental_scan"]


# The same SQL with the other rule, and beside it the hygiene rules that hold no class with a line end.
ORACLE["regex_scan_across"] = f"""
    SELECT id, repository_id, file_path, line_number, pattern_id, snippet FROM ({ORACLE["regex_scan_multiline"].replace(
        "'[a-z]+[.] *' || chr(10) || '[A-Z][a-z]+ [a-z]+'", _quoted(ACROSS[0].regex)).replace("ml_break", "ml_across")})
    UNION ALL SELECT id, repository_id, file_path, line_number, pattern_id, snippet FROM ({ORACLE["regex_scan"]})
    WHERE pattern_id IN ('hyg_token', 'hyg_email', 'hyg_license')"""
