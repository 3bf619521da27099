"""Times the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

The text-heavy tables come as one row group each, which one task would have to read.  They are first (untimed) laid
out in as many files as a scan has tasks, as a cluster would store them; rows and bytes are the same.
Every query is executed completely (no-op sink).  The scan is also given as scanned megabytes per second.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from codesieve.session import build_session  # noqa: E402

HEADLINE = [
    "triage_end_to_end", "regex_scan", "rule_pack_scan", "regex_scan_multiline", "context_snippet", "context_join",
    "dedup_findings", "review_queue_full", "repo_report", "repo_filter_stats", "framework_detect", "repo_score",
    "repos_upsert", "capped_windows", "window_assign", "sast_end_to_end", "sast_summary", "source_excerpt",
    "triage_summary", "export_plan", "code_search", "finding_id",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    slots = os.cpu_count() if cpus == "*" else int(cpus)
    spark = build_session("codesieve-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=slots,
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    # Untimed: lets the JVM load Parquet, shuffle and sink classes.
    spark.read.parquet(f"{sf_dir}/nation.parquet").groupBy("n_regionkey").count().orderBy("count").write.format(
        "noop").mode("overwrite").save()
    laid_out = tempfile.mkdtemp(prefix="codesieve-bench-")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        if path.stem in ("documents", "lineitem", "conversations"):
            spark.read.parquet(str(path)).repartition(2 * slots).write.parquet(f"{laid_out}/{path.name}")
        else:
            os.symlink(path, f"{laid_out}/{path.name}")
    times = {}
    for name in names:
        if name not in QUERIES:
            continue
        start = time.time()
        QUERIES[name](spark, laid_out).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    text_bytes = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("sum(octet_length(text))").first()[0]
    shutil.rmtree(laid_out)
    result = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
              "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": cpus}
    if "regex_scan" in times:
        result["scan_mb_per_sec"] = round(text_bytes / 1e6 / times["regex_scan"], 1)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
