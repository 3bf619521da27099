"""Source context for findings that were produced elsewhere.

``scan_lines(context=...)`` cuts the context while it scans.  The joins here serve findings read from a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.constants import CONTEXT_LINES, EXCERPT_LINES
from codesieve.functions.text import excerpt_text, line_count, raw_lines, window_text
from codesieve.operators.partitioning import join_wide

FILE = ["repository_id", "file_path"]


def attach_context(findings: DataFrame, files: DataFrame, around: int = CONTEXT_LINES) -> DataFrame:
    """Replace ``snippet`` by the lines around the finding.

    A file that is missing in a present repository gives an empty snippet; a finding of an absent repository
    keeps its text.
    """
    present = files.select("repository_id").distinct().withColumn("_present", F.lit(True))
    cut = _windows(findings.select(*FILE, "line_number"), files, around)
    joined = findings.join(cut, [*FILE, "line_number"], "left")
    joined = join_wide(joined, present, "repository_id", "left")
    text = F.coalesce("_text", F.when(F.col("_present"), F.lit("")), "snippet")
    return joined.withColumn("snippet", text).select(*findings.columns)


def _windows(located: DataFrame, files: DataFrame, around: int) -> DataFrame:
    """Context text per (file, line).

    The line numbers of a file (never more than the file has lines) meet its text once, so a text is split once
    however many findings it has, and only Spark's own size check decides whether the text side has to move.
    """
    per_file = located.groupBy(*FILE).agg(F.collect_set("line_number").alias("_numbers"))
    split = files.select(*FILE, "content").join(per_file, FILE).select(
        *FILE, "_numbers", raw_lines(F.col("content")).alias("_lines"), "content")
    counted = split.withColumn("_count", F.coalesce(line_count(F.col("content"), F.col("_lines")), F.lit(0)))
    rows = counted.select(*FILE, "_lines", "_count", F.explode_outer("_numbers").alias("line_number"))
    text = window_text(F.col("_lines"), F.col("_count"), F.col("line_number"), around)
    return rows.select(*FILE, "line_number", F.coalesce(text, F.lit("")).alias("_text"))


def context_by_window(files: DataFrame, around: int = CONTEXT_LINES) -> DataFrame:
    """Every line of every file with its context: a sliding window inside the file's row, without a shuffle."""
    pieces = files.select(*FILE, "content", raw_lines(F.col("content")).alias("_lines"))
    counted = pieces.select(*FILE, "_lines", F.coalesce(
        line_count(F.col("content"), F.col("_lines")), F.lit(0)).alias("_count"))
    shown = F.transform(
        F.slice("_lines", F.lit(1), F.col("_count")),
        lambda line, i: F.struct(
            (i + 1).alias("line_number"), line.alias("line"),
            window_text(F.col("_lines"), F.col("_count"), i + 1, around).alias("snippet")))
    return counted.select(*FILE, F.explode(shown).alias("_w")).select(*FILE, "_w.*")


def attach_excerpt(flaws: DataFrame, files: DataFrame, around: int = EXCERPT_LINES) -> DataFrame:
    """Add ``source_excerpt`` to flaws (repo, file, line).

    The flaw's path is tried as it is and without its first component, in this order.
    """
    key, file, line = ["_repo", "_path"], F.coalesce("file", F.lit("")), F.coalesce("line", F.lit(0))
    path = F.ltrim(F.translate(file, "\\", "/"), F.lit("/"))
    # Flaws without a path have nothing to meet and stay where they are.
    placed = flaws.where(file != "").withColumns({"_repo": F.coalesce("repo", F.lit("")), "_path": path})
    placeless = flaws.where(file == "").withColumn("source_excerpt", F.lit("[no source path]"))
    # A text moves once at most, to its own path, however many spellings flaws have for it, and is split there; flaws go
    # there, and once more if only the shorter path can exist.  An excerpt, cut for each flaw, never moves.
    named = files.select(F.col("repository_id").alias("_repo"), F.col("file_path").alias("_path"), "content")
    pieces = named.dropDuplicates(key).withColumn("_lines", raw_lines(F.col("content")))
    texts = pieces.select(*key, "_lines", F.coalesce(line_count(F.col("content"), F.col("_lines")), F.lit(0)).alias(
        "_count")).hint("merge")
    found = placed.join(texts, key)
    # A path that is not there stays the key of its flaws: it spreads them, and meets no text.
    shorter = F.when(F.contains("_path", F.lit("/")), F.regexp_replace("_path", "^[^/]+/+", ""))
    gone = placed.join(named.select(*key).distinct().hint("merge"), key, "left_anti").withColumn(
        "_path", F.coalesce(shorter, "_path"))
    text = F.coalesce(excerpt_text(F.col("_lines"), F.col("_count"), line, around),
                      F.concat(F.lit("[source file not found: "), file, F.lit("]")))
    shown = found.unionByName(gone.join(texts, key, "left")).withColumn("source_excerpt", text)
    return shown.select(*flaws.columns, "source_excerpt").unionByName(placeless)
