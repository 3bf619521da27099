"""Small helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.session import durable

__all__ = ["documents", "durable", "hand_back", "indexed", "spread_key", "table"]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def hand_back() -> None:
    """Give memory that a worker no longer uses back to the system: the process waits for other stages' work."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def spread_key(column: Column) -> Column:
    """Text that puts ids into a fixed random order: the same in every engine that has MD5."""
    return F.md5(F.coalesce(column.cast("string"), F.lit("")))


def indexed(df: DataFrame, group: list[str], order: list[str], bin_column: Column, name: str) -> DataFrame:
    """Number the rows of each group from 0 in ``name``, without putting a group into one task.

    ``bin_column`` cuts every group into bins of bounded size and must not decrease along ``order``.  The
    bins are counted, their offsets are running sums over the (small) table of bins, and rows are numbered
    inside their bin only.
    """
    from pyspark.sql import Window as W

    binned = df.withColumn("_bin", bin_column)
    counts = binned.groupBy(*group, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_bin").alias("_b"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy(*group, "_bin").orderBy(*order)
    same = F.col("_bin") == F.col("_b")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    numbered = binned.withColumn("_inside", F.row_number().over(inside) - 1)
    # Every row has its bin; as a left join, which a filter on the number must not turn into an inner one, only the bins
    # can be sent to all tasks and never the rows.
    joined = numbered.join(offsets, same, "left")
    return joined.withColumn(name, F.coalesce("_offset", F.lit(0)) + F.col("_inside")).drop(
        "_bin", "_inside", "_b", "_offset", *[f"_g{i}" for i in range(len(group))])


def bins_of(key: str, bins: int) -> Column:
    """Bin of an MD5 text by its leading bits; grows with the text."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") * bins / float(1 << 32)).cast("int")


def power_of_two(value: float) -> int:
    return 1 << max(0, math.ceil(math.log2(max(value, 1))))
