"""Registered queries: every operator over the whole of the driver's tables.

Array results are joined to text so that both engines compare them alike.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import ACROSS, AS_OF, HYGIENE, MULTILINE, PACK, SEARCHES, table
from codesieve import constants as C
from codesieve.functions import identity, paths, values
from codesieve.functions.text import lines
from codesieve.operators import (
    context, discovery, export, findings, multiline, repositories, sast, scan, search, tables, windows,
)
from codesieve.plans import sast as sast_plan
from codesieve.plans import triage as triage_plan
from codesieve.session import shared_folder
from codesieve.sources import packs, records
from codesieve.sources.dialect import crosses_lines
from codesieve.sources.rules import Rule, rules_frame
from codesieve.sources.stored import store_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AFTER, BEFORE, CAP = date(1995, 1, 1), date(2001, 12, 31), 400


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared inputs ---------------------------------------------------------------------------


def _files(spark, sf):
    return table(spark, sf, "source_files")


def _repos(spark, sf):
    """Repositories with their score; all of them, whether they would be kept or not."""
    return repositories.score_repositories(table(spark, sf, "repositories"), AS_OF, _files(spark, sf))


def _raw(spark, sf, **options):
    return scan.scan_lines(scan.eligible_files(_files(spark, sf)), HYGIENE, **options)


def _scored(spark, sf):
    return findings.score_findings(_raw(spark, sf), _repos(spark, sf))


def _winners(spark, sf):
    return findings.deduplicate(_scored(spark, sf))


def _verdicts(spark, sf):
    return table(spark, sf, "verdicts")


def _sast_results(spark, sf):
    """Result documents as JSON text, one per order and repository, parsed back.

    A document lists the flaws of one order, so its size does not grow with the table.
    """
    # Grouping keeps every flaw, so combining before the shuffle gains nothing: shuffle first.
    rows = table(spark, sf, "flaw_rows").repartition("repo", "scan_file")
    flaw = F.struct(
        "n", "issue_id", "cwe_id", "issue_type", "severity",
        F.struct(F.struct("file", "line").alias("source_file")).alias("files"))
    documents = rows.groupBy(F.col("repo").alias("project"), "scan_file").agg(
        F.to_json(F.struct(F.array_sort(F.collect_list(flaw)).alias("findings"))).alias("value"))
    return records.parse_sast_results(documents)


def _report(spark, sf):
    return findings.repository_report(_scored(spark, sf), _repos(spark, sf), clone_dir="/clones")


# --- sources ---------------------------------------------------------------------------------


def _pack_documents(spark, sf):
    """One pack file per part, with one entry that may be broken."""
    part = table(spark, sf, "part")
    key = F.col("p_partkey")
    pairs = {
        "id": F.concat(F.lit("p"), key.cast("string")), "name": F.col("p_name"),
        "regex": F.when(key % 9 == 4, F.concat(F.lit("["), "p_name")).otherwise(F.col("p_name")),
        "vulnerability_type": F.lower("p_type"),
        "severity_score": F.when(key % 7 == 2, F.lit("bad")).otherwise(F.col("p_size").cast("string")),
        "comment": F.lit("dropped"),
    }
    entry = F.struct(*[v.alias(k) for k, v in pairs.items()])
    without_name = F.struct(*[v.alias(k) for k, v in pairs.items() if k != "name"])
    text = F.when(key % 11 == 3, F.lit("42")).when(key % 8 == 5, F.to_json(without_name)).otherwise(F.to_json(entry))
    value = F.concat(F.lit('{"language": "'), F.lower("p_brand"), F.lit('", "cwe_id": "CWE-1", "patterns": ['), text, F.lit("]}"))
    return part.select(F.concat(F.lit("packs/"), F.col("p_brand"), F.lit(".json")).alias("source_file"), value.alias("value"))


@query
def pattern_validate(spark, sf):
    checked = packs.validate_entries(packs.pack_entries(_pack_documents(spark, sf)))
    return checked.select(
        "source_file", "id", "name", "regex", "vulnerability_type", "severity_score", "language", "cwe", "cwe_name",
        F.coalesce("reason", F.lit("valid")).alias("reason"))


@query
def pattern_pack_stats(spark, sf):
    return packs.pack_stats(packs.validate_entries(packs.pack_entries(_pack_documents(spark, sf))))


@query
def source_files_scan(spark, sf):
    return _files(spark, sf).select("repository_id", "file_path", "language", F.length("content").alias("n_chars"),
                                    F.size(lines(F.col("content"))).alias("n_lines"))


@query
def match_events_parse(spark, sf):
    files = _files(spark, sf)
    root = F.concat(F.lit("/clones/"), "repository_id", F.when(F.col("language") == "fr", "/").otherwise(""))
    path = F.when(F.col("language") == "es", F.concat(F.lit("/other/"), "file_path")).otherwise(
        F.concat(F.lit("/clones/"), "repository_id", F.lit("/"), "file_path"))
    data = F.struct(
        F.struct(path.alias("text")).alias("path"),
        F.struct(F.concat("content", F.lit("\n")).alias("text")).alias("lines"),
        F.length("content").alias("line_number"))
    event = F.to_json(F.struct(
        F.when(F.startswith("file_path", F.lit("vendor")), "begin").otherwise("match").alias("type"), data.alias("data")))
    value = F.when(F.startswith("file_path", F.lit("App")), F.concat(F.lit("{oops"), event)).otherwise(event)
    events = files.select("repository_id", root.alias("repo_root"), value.alias("value"), F.lit("ev").alias("pattern_id"),
                          F.lit("xss").alias("vulnerability_type"))
    return records.scanner_findings(events)


@query
def repo_nodes_normalize(spark, sf):
    repos = table(spark, sf, "repositories")
    language = F.when(F.col("language") == "en", "C#").when(F.col("language") == "fr", "JavaScript").when(
        F.col("language") == "de", "")
    nodes = repos.select(
        F.when(F.col("size_mb") > 0, F.substring("id", 4, 20).cast("bigint")).alias("databaseId"), "name", "url",
        F.col("stars").alias("stargazerCount"), F.struct(language.alias("name")).alias("primaryLanguage"),
        F.date_format("last_push", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("pushedAt"),
        (F.col("size_mb") * 100).cast("bigint").alias("diskUsage"),
        F.when(F.col("archived"), F.lit(True)).alias("isArchived"))
    return records.search_repositories(nodes, "PHP").select(
        "id", "name", "url", "stars", "language", F.to_date("last_push").alias("last_push"), "size_mb", "archived")


@query
def repos_scan(spark, sf):
    return table(spark, sf, "repositories").where((F.col("language") == "en") & (F.col("stars") > 1000)).select(
        "id", "name", "stars", "size_mb")


@query
def decode_defaults(spark, sf):
    rows = table(spark, sf, "repositories").select(
        "id", "name", "url", F.col("stars").cast("string").alias("stars"), "language",
        F.when(F.col("archived"), "soon").otherwise(F.date_format("last_push", "yyyy-MM-dd'T'HH:mm:ssXXX")).alias("last_push"),
        F.col("size_mb").cast("string").alias("size_mb"), F.col("archived").cast("int").alias("archived"), "framework",
        F.lit("0").alias("score"),
        F.when(F.col("language") == "fr", '["a","b"]').when(F.col("language") == "de", "[broken").alias("matched_pattern_ids"))
    typed = records.decode_repositories(rows).withColumn("last_push", F.to_date("last_push"))
    lists = records.decode_findings(rows.select("id", "matched_pattern_ids"))
    return typed.join(lists, "id").select("id", "stars", "last_push", "size_mb", "archived", "score",
                                          F.size("matched_pattern_ids").alias("n_patterns"))


@query
def sast_read(spark, sf):
    return sast.flaws(_sast_results(spark, sf)).select(
        "repo", "scan_file", "pos", "issue_id", "cwe_id", "issue_type", "severity", "file", "line")


# --- writes ----------------------------------------------------------------------------------


@query
def findings_insert_ignore(spark, sf):
    found = _raw(spark, sf)
    stored = found.where(F.col("vulnerability_type").isin("ssrf", "xss"))
    return tables.insert_ignore(stored, found.unionByName(found))


@query
def repos_upsert(spark, sf):
    repos = _repos(spark, sf)
    existing = repos.where(F.col("stars") > 500).withColumn("scored", F.lit(True))
    batch = table(spark, sf, "repositories").where(F.col("stars") < 5000).withColumn("stars", F.col("stars") + 7)
    older = batch.withColumn("stars", F.lit(-1)).withColumn("_seq", F.lit(0))
    latest = tables.last_per_key(older.unionByName(batch.withColumn("_seq", F.lit(1))), "id", "_seq")
    return tables.upsert_repositories(existing, latest).select(
        "id", "name", "url", "stars", "language", F.to_date("last_push").alias("last_push"), "size_mb", "archived",
        "framework", "score", "scored")


@query
def patterns_upsert(spark, sf):
    patterns = table(spark, sf, "patterns")
    new = patterns.where(F.col("severity_score") >= 20).withColumn("name", F.upper("name"))
    return tables.replace_by_key(patterns.where(F.col("severity_score") <= 25), new)


@query
def update_by_key(spark, sf):
    repos = table(spark, sf, "repositories").select("id", "framework", F.lit(False).alias("framework_detected"))
    updates = _signals(spark, sf).groupBy(F.col("repository_id").alias("id")).agg(F.max("value").alias("framework"))
    return tables.update_by_key(repos, updates, "id", ["framework"], "framework_detected")


@query
def cascade_delete(spark, sf):
    repos, local, found = table(spark, sf, "repositories"), table(spark, sf, "local_repositories"), _raw(spark, sf)
    doomed = repos.where(repositories.reject_reason().isNotNull()).select("id")
    kept, clones, rest = tables.delete_by_ids(repos, doomed, local, found)
    return (
        kept.select(F.lit("repositories").alias("table_name"), F.col("id").alias("row_key"))
        .unionByName(clones.select(F.lit("local_repositories").alias("table_name"), F.col("repository_id").alias("row_key")))
        .unionByName(rest.select(F.lit("findings").alias("table_name"), F.col("id").alias("row_key"))))


# --- filters and predicates ------------------------------------------------------------------


@query
def repo_filter(spark, sf):
    return repositories.keep_repositories(table(spark, sf, "repositories")).select("id", "name", "stars", "size_mb")


@query
def repo_filter_stats(spark, sf):
    return repositories.filter_stats(table(spark, sf, "repositories"))


@query
def lookup_by_id(spark, sf):
    return table(spark, sf, "repositories").where(F.col("id") == "src7").select("id", "name", "url", "stars")


@query
def already_present(spark, sf):
    repos = table(spark, sf, "repositories").withColumnRenamed("id", "repository_id")
    return tables.already_done(repos, table(spark, sf, "local_repositories"), "repository_id").select("repository_id", "name")


@query
def pending_work(spark, sf):
    repos = table(spark, sf, "repositories").withColumnRenamed("id", "repository_id")
    return tables.not_done(repos, table(spark, sf, "local_repositories"), "repository_id").select("repository_id", "name")


@query
def local_by_language(spark, sf):
    local, repos = table(spark, sf, "local_repositories"), table(spark, sf, "repositories")
    every = tables.local_by_language(local, repos, "en").withColumn("kind", F.lit("all"))
    unscanned = tables.local_by_language(local, repos, "en", unscanned_only=True).withColumn("kind", F.lit("unscanned"))
    return every.unionByName(unscanned)


@query
def patterns_by_language(spark, sf):
    return packs.patterns_of(table(spark, sf, "patterns"), language="economy").select("id", "name", "severity_score")


@query
def patterns_by_cwe(spark, sf):
    return packs.patterns_of(table(spark, sf, "patterns"), cwe="CWE-4").select("id", "name", "severity_score")


@query
def patterns_ordered(spark, sf):
    return packs.ordered_patterns(table(spark, sf, "patterns")).select("id", "language", "severity_score")


@query
def findings_by_repo(spark, sf):
    return findings.by_repository(_scored(spark, sf), "src3").select("id", "file_path", "line_number", "score")


@query
def ignored_paths(spark, sf):
    return _files(spark, sf).select(
        "repository_id", "file_path", paths.is_ignored(F.col("file_path"), C.IGNORED_PATHS).alias("ignored"),
        paths.is_ignored(F.col("file_path"), ["*.en", "App"]).alias("ignored_by_glob"))


def _typed_paths(spark, sf):
    """File paths with program file extensions in place of the language ones."""
    ext = F.when(F.col("language") == "en", ".PHP").when(F.col("language") == "fr", ".tsx").when(
        F.col("language") == "de", ".py").otherwise("")
    return _files(spark, sf).select("repository_id", F.regexp_replace("file_path", "[.][a-z]+$", "").alias("stem"), ext.alias("ext")).select(
        "repository_id", F.concat("stem", "ext").alias("file_path"))


@query
def file_type_filter(spark, sf):
    typed = _typed_paths(spark, sf).withColumn("file_language", paths.language_of(F.col("file_path")))
    return typed.where(F.col("file_language").isNotNull())


@query
def language_alias(spark, sf):
    typed = _typed_paths(spark, sf).withColumn("file_language", paths.language_of(F.col("file_path")))
    return typed.select("repository_id", "file_path", values.pattern_language(F.col("file_language")).alias("pattern_language"))


@query
def relativize_path(spark, sf):
    root = F.concat(F.lit("/clones/"), "repository_id", F.when(F.col("language") == "fr", "/").otherwise(""))
    path = F.when(F.col("language") == "es", F.concat(F.lit("/other/"), "file_path")).otherwise(
        F.concat(F.lit("/clones/"), "repository_id", F.lit("/"), "file_path"))
    return _files(spark, sf).select("repository_id", path.alias("path"), paths.relativize(path, root).alias("relative"))


@query
def code_search(spark, sf):
    wanted = search.Search("[0-9]{3,}", language="en", without_paths=("vendor", "routes"), min_stars=100)
    hits = search.code_search(_files(spark, sf), wanted, table(spark, sf, "repositories"))
    return hits.withColumn("path_tags", F.array_join("path_tags", ","))


@query
def code_searches(spark, sf):
    hits = search.code_searches(_files(spark, sf), SEARCHES, table(spark, sf, "repositories"))
    return hits.select("search", "repository_id", "file_path", "line_number", "line")


@query
def path_tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", F.array_join(paths.path_tags(F.col("url")), ",").alias("tags"))


# --- scan ------------------------------------------------------------------------------------


@query
def regex_scan(spark, sf):
    return _raw(spark, sf)


@query
def rule_pack_scan(spark, sf):
    return scan.scan_lines(table(spark, sf, "code_files"), PACK).drop("snippet")


@query
def regex_scan_multiline(spark, sf):
    return multiline.scan_texts(scan.eligible_files(_files(spark, sf)), MULTILINE)


@query
def regex_scan_across(spark, sf):
    """Rules of lines and of whole texts in one pass."""
    inside = [rule for rule in HYGIENE if not crosses_lines(rule.regex)]
    found = multiline.scan_files(scan.eligible_files(_files(spark, sf)), inside + ACROSS, across_lines=True)
    return found.select("id", "repository_id", "file_path", "line_number", "pattern_id", "snippet")


@query
def merge_adjacent(spark, sf):
    words = [Rule("adj", "word", "[a-z]+ing ", "xss", 3)]
    return multiline.merge_adjacent(scan.scan_lines(scan.eligible_files(_files(spark, sf)), words))


@query
def finding_id(spark, sf):
    return _files(spark, sf).select("repository_id", "file_path", identity.finding_id(
        F.col("repository_id"), F.col("file_path"), F.length("content"), F.substring("content", 1, 40)).alias("id"))


# --- findings --------------------------------------------------------------------------------


@query
def score_findings(spark, sf):
    return _scored(spark, sf).select("id", "file_path", "vulnerability_type", "score")


@query
def dedup_findings(spark, sf):
    return _winners(spark, sf).withColumn("matched_pattern_ids", F.array_join("matched_pattern_ids", ","))


@query
def dedup_window(spark, sf):
    return findings.winners(_scored(spark, sf)).select("id", "repository_id", "file_path", "line_number", "score")


@query
def dedup_losers(spark, sf):
    return findings.losers(_scored(spark, sf)).select("id", "repository_id", "file_path", "line_number", "score")


@query
def dedup_stats(spark, sf):
    return findings.deduplication_stats(_scored(spark, sf))


@query
def duplicate_locations(spark, sf):
    return findings.duplicate_locations(_scored(spark, sf)).withColumn("pattern_ids", F.array_join("pattern_ids", ","))


@query
def distinct_locations(spark, sf):
    return findings.distinct_locations(_raw(spark, sf))


@query
def findings_by_language(spark, sf):
    return findings.of_language(_raw(spark, sf), table(spark, sf, "repositories"), "en").select("id", "repository_id")


def _flagged(spark, sf):
    return _raw(spark, sf).withColumn("finding_scored", F.col("vulnerability_type") == "ssrf")


@query
def pending_by_language(spark, sf):
    return findings.pending(_flagged(spark, sf), "finding_scored", table(spark, sf, "repositories"), "en").select(
        "id", "repository_id", "vulnerability_type")


@query
def count_unscored(spark, sf):
    flagged = _flagged(spark, sf)
    every = findings.count_pending(flagged, "finding_scored").withColumn("kind", F.lit("all"))
    english = findings.count_pending(flagged, "finding_scored", table(spark, sf, "repositories"), "en")
    return every.unionByName(english.withColumn("kind", F.lit("en")))


@query
def review_queue(spark, sf):
    queue = findings.review_queue(_winners(spark, sf), _repos(spark, sf))
    return queue.withColumn("matched_pattern_ids", F.array_join("matched_pattern_ids", ","))


@query
def review_queue_full(spark, sf):
    rows = findings.report_rows(_winners(spark, sf), _repos(spark, sf), table(spark, sf, "local_repositories"), "en")
    return rows.select("finding_id", "repository_name", "framework", "file_path", "line_number", "local_path",
                       "github_url", "combined_score")


@query
def review_queue_top(spark, sf):
    return findings.ranked(findings.review_queue(_winners(spark, sf), _repos(spark, sf)), 25).select(
        "finding_id", "repository_id", "finding_score", "repo_score", "combined_score")


@query
def repo_report(spark, sf):
    return _report(spark, sf).withColumn("vulnerability_types", F.array_join("vulnerability_types", ","))


@query
def category_priority(spark, sf):
    return findings.by_category(_scored(spark, sf)).select("id", "vulnerability_type", "category_rank", "score")


@query
def orphan_findings(spark, sf):
    kept = repositories.keep_repositories(table(spark, sf, "repositories"))
    return tables.orphans(_raw(spark, sf), kept, "repository_id").select("id", "repository_id")


@query
def unique_violations(spark, sf):
    return tables.repeated_texts(table(spark, sf, "documents"), "text")


@query
def orphan_patterns(spark, sf):
    known = rules_frame(spark, HYGIENE[1:])
    return tables.orphans(_raw(spark, sf), known, "pattern_id").select("id", "pattern_id")


# --- context ---------------------------------------------------------------------------------


@query
def context_snippet(spark, sf):
    return _raw(spark, sf, context=3).select("id", "snippet")


@query
def context_join(spark, sf):
    found = _raw(spark, sf)
    there = _files(spark, sf).where((F.col("repository_id") != "src2") & ~F.startswith("file_path", F.lit("App")))
    return context.attach_context(found, there).select("id", "snippet")


def _stored(spark, sf):
    """The source files stored anew in the shared folder."""
    name = "source_files_" + uuid4().hex
    return store_files(_files(spark, sf), name, f"{shared_folder(spark)}/{name}", folders=64, buckets=8)


@query
def context_stored(spark, sf):
    stored = _stored(spark, sf).files()
    there = stored.where((F.col("repository_id") != "src2") & ~F.startswith("file_path", F.lit("App")))
    return context.attach_context(_raw(spark, sf), there).select("id", "snippet")


@query
def context_window(spark, sf):
    return context.context_by_window(_files(spark, sf)).select("repository_id", "file_path", "line_number", "snippet")


@query
def source_excerpt(spark, sf):
    rows = sast.qualifying(sast.flaws(_sast_results(spark, sf)))
    return context.attach_excerpt(rows, _files(spark, sf)).select(
        "repo", "scan_file", "pos", "file", "line", "source_excerpt")


# --- repositories ----------------------------------------------------------------------------


def _signals(spark, sf):
    """Words of conversation texts as signals of the repositories they are dealt to."""
    words = F.explode(F.split("text", " "))
    talk = table(spark, sf, "conversations").select(
        F.concat(F.lit("src"), F.col("conv_id").cast("string")).alias("repository_id"), words.alias("value"))
    root = F.when(F.col("repository_id").endswith("1"), "composer.json").when(
        F.col("repository_id").endswith("2"), "Startup.cs").when(F.col("repository_id").endswith("3"), "my-Django-app")
    marks = talk.select("repository_id", root.alias("value")).where(F.col("value").isNotNull())
    return talk.unionByName(marks).unionByName(
        marks.where(F.col("value") == "composer.json").where(F.col("repository_id").endswith("11")).withColumn(
            "value", F.lit("artisan")))


@query
def framework_detect(spark, sf):
    return repositories.detect_frameworks(table(spark, sf, "repositories"), _signals(spark, sf)).select("id", "framework")


@query
def repo_score(spark, sf):
    return _repos(spark, sf).select("id", "stars", "framework", "score")


@query
def repo_score_first_run(spark, sf):
    return repositories.score_repositories(table(spark, sf, "repositories"), AS_OF).select("id", "score")


@query
def repos_by_score(spark, sf):
    return repositories.by_score(_repos(spark, sf)).select("id", "score")


@query
def owner_repo(spark, sf):
    parts = paths.owner_and_repo(F.col("url"))
    return table(spark, sf, "pages").select("page_id", parts["owner"].alias("owner"), parts["repo"].alias("repo"))


@query
def blob_url(spark, sf):
    files = _files(spark, sf)
    style = F.when(F.col("language") == "fr", F.concat(F.lit("E:\\clones\\"), "repository_id", F.lit("\\"), F.translate("file_path", "/", "\\"))).when(
        F.col("language") == "de", F.concat(F.lit("/clones/"), "repository_id", F.lit("/"), "file_path")).when(
        F.col("language") == "es", F.concat(F.lit("/elsewhere/"), "file_path")).otherwise(F.col("file_path"))
    root = F.when(F.col("language") == "fr", F.concat(F.lit("e:\\clones\\"), "repository_id")).otherwise(
        F.concat(F.lit("/clones/"), "repository_id"))
    url = F.when(F.col("repository_id") != "src1", F.concat(F.lit("https://example.test/"), "repository_id"))
    return files.select("repository_id", style.alias("path"), paths.blob_url(url, style, F.length("content"), root).alias("blob"))


@query
def language_normalize(spark, sf):
    name = F.when(F.col("c_mktsegment") == "BUILDING", "C#").when(F.col("c_mktsegment") == "FURNITURE", "").when(
        F.col("c_mktsegment") == "MACHINERY", None).otherwise(F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", values.normalize_language(name, "TypeScript").alias("language"))


@query
def size_mb(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", values.size_mb(F.when(F.col("o_orderstatus") != "P", F.floor("o_totalprice"))).alias("size_mb"))


@query
def query_templates(spark, sf):
    spans = windows.capped_windows(table(spark, sf, "orders"), "o_orderdate", AFTER, BEFORE, CAP)
    return discovery.search_queries(spans)


# --- date windows ----------------------------------------------------------------------------


@query
def capped_windows(spark, sf):
    return windows.capped_windows(table(spark, sf, "orders"), "o_orderdate", AFTER, BEFORE, CAP)


@query
def window_assign(spark, sf):
    rows = windows.assign_windows(table(spark, sf, "orders"), "o_orderdate", AFTER, BEFORE, CAP)
    return rows.select("o_orderkey", "window_start", "window_end")


# --- static analysis, triage, export ---------------------------------------------------------


@query
def sast_qualifying(spark, sf):
    return sast.qualifying(sast.flaws(_sast_results(spark, sf))).select("repo", "issue_id", "cwe_id", "severity")


@query
def sast_top_n(spark, sf):
    rows = sast.qualifying(sast.flaws(_sast_results(spark, sf)))
    return sast.top_per_repository(rows).select("repo", "rank", "severity", "cwe_id", "scan_file", "pos", "issue_id")


@query
def sast_counts(spark, sf):
    return sast.repository_counts(sast.qualifying(sast.flaws(_sast_results(spark, sf))))


@query
def sast_summary(spark, sf):
    report = _report(spark, sf).withColumn("repository_name", F.col("repository_id"))
    return sast.summary(sast.flaws(_sast_results(spark, sf)), report)


@query
def sast_summary_findings(spark, sf):
    rows = sast.flaws(_sast_results(spark, sf))
    found = sast.summary_findings(rows, sast.summary(rows, _report(spark, sf)))
    return found.select("project", "repository_name", "issue_id", "cwe_id", "severity")


@query
def sast_combined(spark, sf):
    docs = sast_plan.documents(_sast_results(spark, sf), _files(spark, sf))
    issues = F.array_join(F.transform("findings", lambda f: f["issue_id"].cast("string")), ",")
    return docs.select("repo", "total_qualifying", "assessed_count", "capped", issues.alias("issue_ids"))


@query
def sast_documents(spark, sf):
    """The combined documents in full: every field of every finding, in its order in the document."""
    docs = sast_plan.documents(_sast_results(spark, sf), _files(spark, sf))
    return docs.select("repo", "total_qualifying", "assessed_count", "capped", F.posexplode("findings").alias("i", "f")).select(
        "repo", "total_qualifying", "assessed_count", "capped", (F.col("i") + 1).alias("place"),
        *[F.col(f"f.{name}") for name in ("rank", "issue_id", "scan_file", "cwe_id", "issue_type", "severity", "file", "line",
                                          "source_excerpt")])


@query
def sast_end_to_end(spark, sf):
    rows = sast_plan.combine(_sast_results(spark, sf), _files(spark, sf))
    return rows.select("repo", "rank", "issue_id", "cwe_id", "severity", "source_excerpt", "total_qualifying", "capped")


@query
def triage_targets(spark, sf):
    return sast.triage_targets(sast.flaws(_sast_results(spark, sf)))


@query
def triage_merge(spark, sf):
    verdicts = _verdicts(spark, sf)
    high, low = verdicts.where(F.col("severity") >= 3), verdicts.where(F.col("severity") < 3)
    return sast.triage_merge(low, high).select("repo", "issue_id", "severity", "verdict")


@query
def triage_summary(spark, sf):
    return sast.triage_summary(_verdicts(spark, sf))


@query
def triage_pivot(spark, sf):
    return sast.verdict_pivot(_verdicts(spark, sf))


def _same_names(spark, sf):
    """The report with the repositories' language as their name, so that names collide."""
    langs = table(spark, sf, "repositories").select(F.col("id").alias("repository_id"), "language")
    return _report(spark, sf).join(langs, "repository_id").withColumn("repository_name", F.col("language")).drop("language")


@query
def export_select(spark, sf):
    return export.export_select(_report(spark, sf), min_score=9, min_findings=2).select(
        "repository_id", "top_score", "finding_count")


@query
def export_names(spark, sf):
    return export.export_names(_same_names(spark, sf)).select("repository_id", "repository_name", "export_name")


@query
def export_plan(spark, sf):
    clones = table(spark, sf, "local_repositories").where(F.col("repository_id") != "src4")
    there = table(spark, sf, "repositories").where(F.col("stars") > 3000).select(F.col("language").alias("export_name"))
    plan = export.export_plan(_same_names(spark, sf), clones, there, min_score=1)
    return plan.select("repository_id", "repository_name", "export_name", "outcome")


# --- incremental and whole runs --------------------------------------------------------------


@query
def incremental_scan(spark, sf):
    done = table(spark, sf, "local_repositories").where(F.col("scanned")).select("repository_id")
    repos = repositories.keep_repositories(table(spark, sf, "repositories"))
    found = triage_plan.scan_repositories(_files(spark, sf), repos, HYGIENE, done=done)
    return found.select("id", "repository_id", "file_path", "line_number", "pattern_id")


@query
def incremental_stored(spark, sf):
    done = table(spark, sf, "local_repositories").where(F.col("scanned")).select("repository_id")
    repos = repositories.keep_repositories(table(spark, sf, "repositories"))
    found = triage_plan.scan_repositories(_stored(spark, sf), repos, HYGIENE, done=done)
    return found.select("id", "repository_id", "file_path", "line_number", "pattern_id")


@query
def triage_end_to_end(spark, sf):
    queue = triage_plan.triage(_files(spark, sf), table(spark, sf, "repositories"), HYGIENE, AS_OF)
    return queue.withColumn("matched_pattern_ids", F.array_join("matched_pattern_ids", ",")).orderBy(
        F.desc("combined_score"), "finding_id")
