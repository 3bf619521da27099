"""Code search: regexes over file lines with language, path and popularity restrictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.functions.paths import path_tags
from codesieve.operators.partitioning import join_wide
from codesieve.operators.scan import scan_lines
from codesieve.sources.rules import Rule


@dataclass(frozen=True)
class Search:
    """A search: regex, optional language, path words to leave out, stars strictly above ``min_stars``.

    ``quoted`` takes the text literally instead of as a regex.
    """

    regex: str
    language: str = ""
    without_paths: Sequence[str] = ()
    min_stars: int | None = None
    quoted: bool = False


def _regex(search: Search) -> str:
    """The search as a regex; a quoted one taken literally."""
    return "".join("\\" + c if c in r"\.^$|?*+()[]{}" else c for c in search.regex) if search.quoted else search.regex


def code_search(files: DataFrame, search: Search, repositories: DataFrame | None = None) -> DataFrame:
    """Lines that match ``search``: repository, path, line number, line and path tags."""
    return code_searches(files, {"search": search}, repositories).drop("search")


def code_searches(files: DataFrame, searches: Mapping[str, Search], repositories: DataFrame | None = None) -> DataFrame:
    """Lines that match any of the named searches, one row for each that a line matches: ``search`` and as above.

    All searches run in one scan of the texts, as the rules of a pack.  Restrictions by path and popularity are then
    put to the (few) hits; a file that the paths of all searches leave out is not scanned.
    """
    rules = [Rule(name, name, _regex(search), "", 0, search.language) for name, search in searches.items()]

    def path_allows(search: Search) -> Column:
        return reduce(and_, [~F.contains(F.lower("file_path"), F.lit(word.lower())) for word in search.without_paths],
                      F.lit(True))

    chosen = files.where(reduce(or_, [path_allows(search) for search in searches.values()], F.lit(False)))
    hits = scan_lines(chosen, rules, strict=True)
    allowed = [(F.col("pattern_id") == name) & path_allows(search) for name, search in searches.items()]
    hits = hits.where(reduce(or_, allowed, F.lit(False)))
    least = {name: search.min_stars for name, search in searches.items() if search.min_stars is not None}
    if least:
        wanted = F.create_map(*[F.lit(x) for item in least.items() for x in item])[F.col("pattern_id")]
        stars = repositories.select(F.col("id").alias("repository_id"), "stars").where(F.col("stars") > min(least.values()))
        hits = join_wide(hits, stars, "repository_id", "left" if len(least) < len(searches) else "inner").where(
            wanted.isNull() | F.coalesce(F.col("stars") > wanted, F.lit(False)))
    return hits.select(F.col("pattern_id").alias("search"), "repository_id", "file_path", "line_number",
                       F.col("snippet").alias("line"), path_tags(F.col("file_path")).alias("path_tags"))


#: A small catalogue of our own for reviewing source code.
CATALOGUE = {
    "shell_call": Search(r"\b(system|popen|exec|shell_exec)\s*\("),
    "sql_concat": Search(r"(?i)\b(select|insert|update|delete)\b[^;]*[\"']\s*[+.]\s*\w", without_paths=("test", "migrations")),
    "weak_hash": Search(r"(?i)\b(md5|sha1)\s*\("),
    "private_key": Search("-----BEGIN PRIVATE KEY-----", quoted=True),
    "hard_coded_password": Search(r"(?i)passw(or)?d\s*[:=]\s*[\"'][^\"']{4,}", without_paths=("test", "example")),
    "debug_switch": Search(r"(?i)\bdebug\s*=\s*(true|1)\b"),
    "open_redirect": Search(r"(?i)redirect\s*\(\s*(req|request|params)"),
    "raw_html": Search(r"(innerHTML|dangerouslySetInnerHTML|\|\s*safe)"),
    "unpickling": Search(r"\b(pickle|marshal)\.loads?\s*\(", language="python"),
    "unserialize": Search("unserialize(", language="php", quoted=True),
    "tls_off": Search(r"(?i)(verify\s*=\s*False|rejectUnauthorized\s*:\s*false)"),
    "to_do_security": Search(r"(?i)\b(todo|fixme)\b.*\b(auth|security|escape|sanitize)"),
}
