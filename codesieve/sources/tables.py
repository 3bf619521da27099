"""Tables stored as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table.  How many tasks read it is set by ``spark.sql.files.maxPartitionBytes`` and its row groups."""
    return spark.read.parquet(path)
