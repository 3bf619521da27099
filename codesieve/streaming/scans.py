"""Scanning files as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codesieve import schemas
from codesieve.constants import CONTEXT_LINES, IGNORED_PATHS
from codesieve.operators.multiline import scan_files
from codesieve.operators.scan import eligible_files
from codesieve.sources.rules import Rule


def stream_source_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Parquet ``source_files`` as a stream."""
    reader = spark.readStream.schema(schemas.SOURCE_FILES)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_findings(
    files: DataFrame, rules: Sequence[Rule], ignored: Sequence[str] = IGNORED_PATHS, context: int = CONTEXT_LINES
) -> DataFrame:
    """Findings of arriving files: the batch scan kernel, narrow and stateless."""
    return scan_files(eligible_files(files, ignored), rules, context=context)


def write_findings_stream(findings: DataFrame, target: str, checkpoint: str, remember: str | None = None,
                          **trigger: object) -> StreamingQuery:
    """Append findings whose id is new to the Parquet files in ``target``.

    The ids that were written are keyed state of the query: a batch looks up its own ids, by a shuffle of its findings on the id,
    and reads nothing that earlier batches wrote.  With ``remember`` ("30 days") an id is forgotten so long after the batch that
    brought it, and the state is bounded by what arrives in that time; without, ids are kept for good (take the RocksDB state
    store).  The sink's log makes a batch that is delivered again leave the files as they were; Spark compacts that log.
    """
    if remember is None:
        fresh = findings.dropDuplicates(["id"])
    else:
        timed = findings.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember)
        fresh = timed.dropDuplicatesWithinWatermark(["id"]).drop("_arrived")
    return (
        fresh.writeStream.format("parquet").outputMode("append").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def deduplicate_stream(findings: DataFrame, time_column: str, delay: str) -> DataFrame:
    """First finding per id; the state forgets an id once the watermark has passed it by ``delay``."""
    return findings.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(["id"])
