"""Schemas (DDL text) of the tables the transforms exchange."""

from __future__ import annotations

REPOSITORIES = (
    "id string, name string, url string, stars int, language string, last_push timestamp, size_mb int, "
    "archived boolean, framework string, score int, filtered boolean, scored boolean, "
    "framework_detected boolean, created_at timestamp"
)
LOCAL_REPOSITORIES = ("repository_id string, local_path string, clone_timestamp timestamp, scanned boolean")
SOURCE_FILES = ("repository_id string, file_path string, language string, content string")
PATTERNS = (
    "id string, name string, regex string, vulnerability_type string, severity_score int, language string, "
    "cwe string, cwe_name string"
)
FINDINGS = (
    "id string, repository_id string, file_path string, line_number int, pattern_id string, "
    "vulnerability_type string, snippet string, matched_pattern_ids array<string>, score int, "
    "enriched boolean, finding_scored boolean, created_at timestamp"
)
REPO_REPORT = (
    "repository_id string, repository_name string, repository_url string, framework string, top_score int, "
    "finding_count bigint, vulnerability_types array<string>, local_path string"
)
SEARCH_NODE = (
    "databaseId bigint, name string, url string, stargazerCount int, primaryLanguage struct<name:string>, "
    "pushedAt string, diskUsage bigint, isArchived boolean, "
    "repositoryTopics struct<nodes:array<struct<topic:struct<name:string>>>>"
)
SCAN_EVENT = (
    "type string, data struct<path:struct<text:string>, lines:struct<text:string>, line_number:int, "
    "absolute_offset:bigint, submatches:array<struct<start:int, end:int>>>"
)
SAST_RESULT = (
    "findings array<struct<issue_id:bigint, cwe_id:string, issue_type:string, severity:int, "
    "files:struct<source_file:struct<file:string, line:int>>, display_text:string, flaw_details:string, "
    "description:string, cwename:string, stack_dumps:string>>"
)
TRIAGE_VERDICT = (
    "repo string, issue_id bigint, cwe_id string, issue_type string, severity int, file string, line int, "
    "verdict string, confidence string, summary string, reasoning string, source_excerpt string"
)
