"""Post-processing of static-analysis results from result files to documents and summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve import constants as C
from codesieve.operators import sast
from codesieve.operators.context import attach_excerpt
from codesieve.session import durable
from codesieve.sources.stored import StoredFiles


def combine(
    results: DataFrame, files: DataFrame | StoredFiles, cwes: Sequence[str] = C.SAST_CWES, cap: int = C.SAST_CAP,
) -> DataFrame:
    """Capped, excerpted flaws per repository as rows, with the repository's counts.

    The result files are parsed once: what counts, ranks and excerpts need of each is stored, at most ``cap`` flaws.  Of
    these the ``cap`` first per repository are stored again, for the two passes that excerpts take.
    """
    condensed = durable(sast.per_file(results, cwes, cap))
    top = durable(sast.top_per_repository(sast.flaws_of(condensed), cap))
    texts = files.files() if isinstance(files, StoredFiles) else files
    return attach_excerpt(top, texts).join(sast.counts_of(condensed, cap), "repo")


def documents(
    results: DataFrame, files: DataFrame | StoredFiles, cwes: Sequence[str] = C.SAST_CWES, cap: int = C.SAST_CAP,
) -> DataFrame:
    """The same as one document per repository."""
    fields = ["rank", "issue_id", "scan_file", "cwe_id", "issue_type", "severity", "file", "line", "source_excerpt",
              "display_text", "flaw_details", "description", "cwename", "stack_dumps"]
    counts = ["repo", "total_qualifying", "assessed_count", "capped"]
    # At most ``cap`` rows per group, so the list is bounded.
    return combine(results, files, cwes, cap).groupBy(*counts).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("findings"))
