"""Date windows that hold at most a given number of rows, and the assignment of rows to them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.constants import SEARCH_CAP
from codesieve.operators.partitioning import join_hot

_NODE = "struct<depth:int,lower:date,upper:date>"


def _bisection_path(day: Column, after: date, before: date) -> Column:
    """All windows of the bisection of [after, before] that contain ``day``, widest first.

    Windows of two or more days' distance are halved at ``lower + distance // 2``; the middle day opens the
    right half.  Where the halves lie depends on the dates only, so a day knows its windows without any counts.
    """
    depth = max((before - after).days, 1).bit_length() + 1
    root = F.struct(F.lit(0).alias("depth"), F.lit(after).alias("lower"), F.lit(before).alias("upper"))

    def descend(path: Column, level: Column) -> Column:
        top = F.get(path, F.size(path) - 1)
        distance = F.datediff(top["upper"], top["lower"])
        middle = F.date_add(top["lower"], F.floor(distance / 2).cast("int"))
        left = day < middle
        half = F.struct(
            level.alias("depth"),
            F.when(left, top["lower"]).otherwise(middle).alias("lower"),
            F.when(left, F.date_sub(middle, 1)).otherwise(top["upper"]).alias("upper"))
        return F.when(distance >= 2, F.concat(path, F.array(half))).otherwise(path)

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array(root).cast(f"array<{_NODE}>"), descend)


def _day_windows(rows: DataFrame, column: str, after: date, before: date, cap: int) -> DataFrame:
    """Accepted window of each day that has rows: (day, window_start, window_end, row_count, over_cap)."""
    day = F.to_date(column)
    days = rows.select(day.alias("day")).where(F.col("day").between(F.lit(after), F.lit(before))).groupBy("day").agg(
        F.count("*").alias("n"))
    paths = days.select("day", "n", F.explode(_bisection_path(F.col("day"), after, before)).alias("w"))
    counts = paths.groupBy("w").agg(F.sum("n").alias("row_count"))
    # A window is final when it fits or cannot be halved; per day the widest final one is used.
    final = counts.where((F.col("row_count") <= cap) | (F.datediff("w.upper", "w.lower") < 2))
    return (
        paths.join(final, "w").groupBy("day")
        .agg(F.min_by(F.struct("w", "row_count"), F.col("w.depth")).alias("best"))
        .select("day", F.col("best.w.lower").alias("window_start"), F.col("best.w.upper").alias("window_end"),
                F.col("best.row_count").alias("row_count"), (F.col("best.row_count") > cap).alias("over_cap"))
    )


def capped_windows(rows: DataFrame, column: str, after: date, before: date, cap: int = SEARCH_CAP) -> DataFrame:
    """Windows from bisecting [after, before] until each holds at most ``cap`` rows or spans under two days' distance.

    Empty windows are left out; a window that cannot be halved any more is kept with ``over_cap``.
    """
    return _day_windows(rows, column, after, before, cap).drop("day").distinct().orderBy("window_start")


def assign_windows(rows: DataFrame, column: str, after: date, before: date, cap: int = SEARCH_CAP) -> DataFrame:
    """Rows within [after, before] with the window they belong to.

    An equality join on the day (at most one row per calendar day of the range) instead of a range join; a day
    that holds much of the rows is dealt to several tasks.
    """
    windows = _day_windows(rows, column, after, before, cap).select("day", "window_start", "window_end")
    dated = rows.withColumn("day", F.to_date(column))
    return join_hot(dated, windows, "day").drop("day")
