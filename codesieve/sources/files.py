"""Source files from folders of checked-out repositories."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.constants import EXTENSIONS, IGNORED_PATHS
from codesieve.functions.paths import glob_regex, language_of


def read_source_files(
    spark: SparkSession, root: str, ignored: Sequence[str] = IGNORED_PATHS, languages: Sequence[str] | None = None
) -> DataFrame:
    """``source_files`` of a folder with one sub-folder per repository.

    Extensions are pruned by the listing (``pathGlobFilter``) and ignored folders by the listed path
    (``_metadata.file_path``), both before any text is read.
    """
    wanted = [ext for lang, exts in EXTENSIONS.items() if languages is None or lang in languages for ext in exts]
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{" + ",".join(wanted) + "}").load(root)
    )
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    qualified = system.makeQualified(folder).toString()
    if ignored:
        listed = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        files = files.where(~inside_repository(below(listed, qualified)).rlike(glob_regex(ignored)))
    return split_paths(files, qualified, ignored)


def below(path: Column, root: str) -> Column:
    """Path below ``root``; scheme and host are left out of both, so the root is cut off once, by its length."""
    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?"
    length = len(re.sub(scheme, "", root.rstrip("/"))) + 1
    return F.substring(F.regexp_replace(path, scheme, ""), length + 1, 1 << 30)


def inside_repository(tail: Column) -> Column:
    """Path without its first folder, the repository."""
    return F.regexp_replace(tail, "^[^/]*/", "")


def split_paths(files: DataFrame, root: str, ignored: Sequence[str] = IGNORED_PATHS) -> DataFrame:
    """(repository_id, file_path, language, content) for binary file rows below ``root``."""
    tail = below(F.col("path"), root)
    located = files.select(
        F.substring_index(tail, "/", 1).alias("repository_id"),
        inside_repository(tail).alias("file_path"), "content")
    kept = located.where(~F.col("file_path").rlike(glob_regex(ignored))) if ignored else located
    # Bytes that are no UTF-8 become the replacement character instead of losing the file.
    return kept.select("repository_id", "file_path", language_of(F.col("file_path")).alias("language"),
                       F.make_valid_utf8(F.col("content").cast("string")).alias("content"))
