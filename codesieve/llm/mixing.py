"""Interleaving of sources to target weights by Pfair scheduling; DataFrame functions only.

Every source is cut into blocks of equally many rows.  Weights are whole numbers of slots of a period.  The i-th
block of a source with n of D slots is released at floor((i - 1) D / n) and due by ceil(i D / n); in each slot the
released block with the earliest deadline goes next.  One period is scheduled once; later periods repeat it, so that
a block's slot is an equality join with the period.  After any number of slots each source is less than one block
from its share.  A source that has ended leaves its slots empty; the others keep their order and rates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codesieve.llm.common import bins_of, durable, indexed, spread_key

BLOCK_ROWS = 64
#: Slots of a period that are shared out; every source gets at least one.
RESOLUTION = 1000
#: Rows of a source that one task numbers.
BIN_ROWS = 20_000


def smoothed_weights(df: DataFrame, source_column: str = "source", resolution: int = RESOLUTION) -> DataFrame:
    """``_source``, ``_slots``: shares in proportion to the square root of a source's rows, the usual smoothing."""
    counts = df.groupBy(F.col(source_column).alias("_source")).agg(F.count(F.lit(1)).alias("_rows"))
    return _slots(counts.select("_source", F.sqrt("_rows").alias("_weight")), resolution)


def given_weights(weights: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """``_source``, ``_slots`` of a table source, weight; sources with a null or non-positive weight are left out."""
    good = weights.toDF("_source", "_weight").where("_weight > 0 and _weight < double('infinity')")
    return _slots(good, resolution)


def _slots(weights: DataFrame, resolution: int) -> DataFrame:
    total = weights.agg(F.sum("_weight")).first()[0] or 1.0
    slots = F.greatest(F.lit(1), F.floor(resolution * F.col("_weight") / total + F.lit(0.5)))
    return weights.select("_source", slots.cast("int").alias("_slots"))


def _release(i: Column, n: Column, period: Column) -> Column:
    """First slot of the i-th block, i from 1."""
    return F.floor((i - 1) * period / n)


def _deadline(i: Column, n: Column, period: Column) -> Column:
    return F.ceil(i * period / n)


def period_schedule(slots: DataFrame) -> DataFrame:
    """``_source``, ``_i`` (from 0), ``_slots``, ``_period``, ``_at``: the slot of each block of one period.

    Earliest deadline first among released blocks, ties to the source that sorts first.  The period has about
    ``RESOLUTION`` slots, however large the table is; only its schedule is computed in one row.
    """
    sources = F.array_sort(F.collect_list(F.struct(
        F.col("_source").isNotNull().alias("known"), F.col("_source").alias("source"), F.col("_slots").alias("n"))))
    row = slots.agg(sources.alias("s"), F.sum("_slots").cast("int").alias("period")).where("period > 0")

    def step(state: Column, now: Column) -> Column:
        def due(source: Column, k: Column) -> Column:
            i = F.get(state["done"], k) + 1
            wait = _release(i, source["n"], F.col("period")) <= now
            return F.when(wait & (i <= source["n"]),
                          F.struct(_deadline(i, source["n"], F.col("period")).alias("due"), k.alias("k")))

        return F.struct(state["done"].alias("done"), state["picks"].alias("picks"),
                        F.array_min(F.transform(F.col("s"), due))["k"].alias("pick"))

    def follow(state: Column, now: Column) -> Column:
        chosen = step(state, now)["pick"]
        # The pick is the last entry of a one-element array so that it is worked out once a slot.
        return F.element_at(F.transform(F.array(chosen), lambda pick: F.struct(
            F.transform(state["done"], lambda x, k: F.when(k == pick, x + 1).otherwise(x)).alias("done"),
            F.concat(state["picks"], F.array(pick)).alias("picks"))), 1)

    start = F.struct(F.transform("s", lambda _: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("picks"))
    picks = F.aggregate(F.sequence(F.lit(0), F.col("period") - 1), start, follow, lambda state: state["picks"])
    in_turn = row.select("s", "period", F.posexplode(picks).alias("_at", "k"))
    return in_turn.select(
        F.get("s", "k")["source"].alias("_source"), F.get("s", "k")["n"].alias("_slots"),
        F.col("period").alias("_period"), "_at", (F.row_number().over(W.partitionBy("k").orderBy("_at")) - 1).alias("_i"))


def mix(df: DataFrame, weights: DataFrame | None = None, id_column: str = "doc_id", source_column: str = "source",
        block_rows: int = BLOCK_ROWS, resolution: int = RESOLUTION) -> DataFrame:
    """One row per row of ``df``: the id, source, block (of its source, from 0), slot, place (in the block).

    Rows sorted by slot and place are the mixture: each is there exactly once.  Inside a source rows are in the
    order of the MD5 of their id, a fixed shuffle.  ``weights``: source and weight; without it shares follow the
    square root of the sources' rows.  A null source is a source of its own.  Sources without a positive weight
    come after all others: their slot is null.  Rows repeated with one id are told apart by their place.  Other
    columns are not read; an empty table gives an empty result.
    """
    rows = durable(df.select(F.col(id_column).alias("_id"), F.col(source_column).alias("_source"),
                             spread_key(F.col(id_column)).alias("_key")))
    bins = max(1, -(-rows.count() // BIN_ROWS))
    numbered = indexed(rows, ["_source"], ["_key", "_id"], bins_of("_key", bins), "_n")
    slots = given_weights(weights, resolution) if weights is not None else smoothed_weights(rows, "_source", resolution)
    period = durable(period_schedule(slots))
    block = F.floor(F.col("_n") / block_rows)
    blocks = numbered.select("_id", "_source", block.alias("block"), (F.col("_n") % block_rows).alias("place"))
    shares = period.select("_source", "_slots", "_period").distinct().withColumnRenamed("_source", "_s")
    placed = blocks.join(shares, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumn(
        "_turn", F.floor(F.col("block") / F.col("_slots"))).withColumn("_in", F.col("block") % F.col("_slots"))
    at = period.select(F.col("_source").alias("_s"), F.col("_i"), "_at")
    same = F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_in") == F.col("_i"))
    return placed.join(at, same, "left").select(
        F.col("_id").alias(id_column), F.col("_source").alias(source_column), F.col("block").cast("long"),
        (F.col("_turn") * F.col("_period") + F.col("_at")).cast("long").alias("slot"), F.col("place").cast("long"))


def mixed_rows(df: DataFrame, weights: DataFrame | None = None, id_column: str = "doc_id",
               source_column: str = "source", position: str | None = None, **options) -> DataFrame:
    """All rows and columns of ``df`` in mixture order: partitions hold consecutive slots and are sorted by them.

    Rows that share id and source are put where the first of them belongs.  ``position`` names a column to be added,
    a struct of slot and place: sorting by it gives the order again after the rows were written and reread.  Columns
    of ``df`` may have any names, a column of that name is replaced.
    """
    order = mix(df, weights, id_column, source_column, **options)
    first = order.groupBy(F.col(id_column).alias("id"), F.col(source_column).alias("from")).agg(
        F.min(F.struct(F.coalesce("slot", F.lit((1 << 63) - 1)).alias("slot"), "place")).alias("at"))
    named = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    whole = df.select(F.struct(*named).alias("row"))
    same = F.col("row").getField(id_column).eqNullSafe(F.col("id")) & F.col("row").getField(
        source_column).eqNullSafe(F.col("from"))
    joined = whole.join(first, same, "left")
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = joined.repartitionByRange(partitions, "at.slot", "at.place").sortWithinPartitions("at.slot", "at.place")
    columns = [F.col("row").getField(c).alias(c) for c in df.columns if c != position]
    return spread.select(*columns, *([F.col("at").alias(position)] if position else []))
