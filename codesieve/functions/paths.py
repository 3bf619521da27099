"""Path and URL functions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from codesieve.constants import EXTENSIONS, PATH_TAGS


def glob_regex(globs: Sequence[str]) -> str:
    """One anchored regex for path-component globs.

    A glob without a slash hits a file or folder of that name at any depth; with a slash it starts at the root.
    """
    floating, rooted = [], []
    for glob in globs:
        body = glob.strip("/")
        text = "".join(
            {"*": "[^/]*", "?": "[^/]"}.get(part, re.escape(part)) for part in re.split(r"([*?])", body) if part
        )
        (rooted if "/" in body else floating).append(text)
    options = []
    if floating:
        options.append(f"(^|/)({'|'.join(floating)})(/|$)")
    if rooted:
        options.append(f"^/?({'|'.join(rooted)})(/|$)")
    return "|".join(options)


def is_ignored(path: Column, globs: Sequence[str]) -> Column:
    """True where any component of ``path`` is excluded by ``globs``."""
    return path.rlike(glob_regex(globs)) if globs else F.lit(False)


def is_hidden(path: Column) -> Column:
    """True where a component starts with a dot."""
    return path.rlike(r"(^|/)\.[^/.]")


def extension(path: Column) -> Column:
    """Lower-case extension of the last component, empty if there is none."""
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def language_of(path: Column) -> Column:
    """Language by file extension; null for files no pattern applies to."""
    ext = extension(path)
    result = None
    for language, names in EXTENSIONS.items():
        result = F.when(ext.isin(*names), language) if result is None else result.when(ext.isin(*names), language)
    return result


def relativize(path: Column, root: Column) -> Column:
    """``path`` below ``root`` (with or without trailing slash); unchanged when it lies elsewhere."""
    base = F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))
    return F.when(F.startswith(path, base), path.substr(F.length(base) + 1, F.length(path))).otherwise(path)


def _tidy(path: Column) -> Column:
    """Drop empty and single-dot components."""
    return F.rtrim(
        F.regexp_replace(F.regexp_replace(path, r"(?<=^|/)(\./+)+|(?<=/)\.$", ""), "/{2,}", "/"), F.lit("/")
    )


def blob_url(
    repo_url: Column, file_path: Column, line_number: Column, local_path: Column | None = None
) -> Column:
    """Web address of a finding's line, null when the repository address or the path is missing.

    Relative paths are used as they are.  Absolute POSIX and Windows paths lose the clone root when they lie
    below it, otherwise only the drive letter and the leading slashes.
    """
    root = F.lit(None).cast("string") if local_path is None else local_path
    windows = file_path.rlike(r"^[A-Za-z]:[\\/]")
    posix = F.startswith(file_path, F.lit("/"))
    forward = F.when(windows, F.translate(file_path, "\\", "/")).otherwise(file_path)
    base = F.concat(F.rtrim(F.when(windows, F.translate(root, "\\", "/")).otherwise(root), F.lit("/")), F.lit("/"))
    below = F.when(windows, F.startswith(F.lower(forward), F.lower(base))).otherwise(F.startswith(forward, base))
    rest = forward.substr(F.length(base) + 1, F.length(forward))
    bare = F.ltrim(F.when(windows, forward.substr(F.lit(3), F.length(forward))).otherwise(forward), F.lit("/"))
    relative = F.when(
        windows | posix, F.when(F.coalesce(below & (F.length(root) > 0), F.lit(False)), rest).otherwise(bare)
    ).otherwise(F.ltrim(file_path, F.lit("/")))
    usable = (F.length(repo_url) > 0) & (F.length(file_path) > 0)
    return F.when(
        usable,
        F.concat(repo_url, F.lit("/blob/HEAD/"), _tidy(relative), F.lit("#L"), line_number.cast("string")),
    )


def owner_and_repo(url: Column) -> Column:
    """Struct (owner, repo): the last two components of a repository address."""
    parts = F.split(F.rtrim(url, F.lit("/")), "/")
    return F.struct(F.try_element_at(parts, F.lit(-2)).alias("owner"), F.try_element_at(parts, F.lit(-1)).alias("repo"))


def path_tags(path: Column) -> Column:
    """Sorted array of the heuristics whose words occur in ``path``."""
    low = F.lower(path)
    tags = [F.when(low.rlike("|".join(words)), F.lit(tag)) for tag, words in sorted(PATH_TAGS.items())]
    return F.array_compact(F.array(*tags))
