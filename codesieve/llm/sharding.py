"""Shards of equal size that cut few links: balanced label propagation with quotas; DataFrame functions only.

Linked documents start in the shard that the hash of their own node names, wherever their neighbours are.  In the
first round all move to the shard where most of their neighbours are, but for those with more links than any
neighbour, which the others gather around; a shard beyond its quota keeps the documents of small groups first and
deals the others to shards with room.  In later rounds documents change places with as many that
want to go the other way, and others move as far as the wanted shard has room.  Documents without links fill what is
left, so that counts differ by one at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import bins_of, durable, indexed, spread_key
from codesieve.operators.partitioning import join_wide
from codesieve.session import shared_folder

SHARDS = 24
ROUNDS = 6
#: Rows that one task numbers.
BIN_ROWS = 20_000


def quotas(rows: int, shards: int) -> list[int]:
    """Documents of each shard: as equal as they can be."""
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def _loads(placed: DataFrame, shards: int) -> list[int]:
    """Documents placed in each shard: one number for each shard comes to the driver."""
    counts = {row[0]: row[1] for row in placed.groupBy("shard").count().collect()}
    return [counts.get(shard, 0) for shard in range(shards)]


def _of(values: list[int], shard: str) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col(shard) + 1)


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder.

    Unlike a checkpoint it is planned by its own size: estimates carried from round to round would multiply until
    they are numbers of millions of digits.
    """
    path = f"{shared_folder(df.sparkSession)}/shards-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fill(rows: DataFrame, order: list[str], bins: Column, room: list[int]) -> DataFrame:
    """Rows with ``shard``: the first go to the first shard until its room is used up, and so on."""
    ends, total = [], 0
    for value in room:
        total += value
        ends.append(F.lit(total).cast("long"))
    numbered = indexed(rows.withColumn("_all", F.lit(0)), ["_all"], order, bins, "_n").drop("_all")
    return numbered.withColumn("shard", F.size(F.filter(F.array(*ends), lambda end: end <= F.col("_n")))).drop("_n")


def _within(wanted: DataFrame, quota: list[int], bins: int) -> DataFrame:
    """Linked documents in the shard they want as far as its quota goes, small groups first; the others where room is."""
    bin_column = F.col("class") * bins + bins_of("key", bins)
    ranked = durable(indexed(wanted, ["shard"], ["class", "key", "node"], bin_column, "_rank"))
    fits = F.col("_rank") < _of(quota, "shard")
    kept, over = ranked.where(fits).drop("_rank"), ranked.where(~fits).drop("_rank")
    room = [q - n for q, n in zip(quota, _loads(kept, len(quota)), strict=True)]
    moved = _fill(over.withColumnRenamed("shard", "from"), ["from", "class", "key", "node"],
                  (F.col("from") * 64 + F.col("class")) * bins + bins_of("key", bins), room)
    return _written(kept.unionByName(moved.drop("from")).select("node", "key", "shard"))


def _gather(both: DataFrame, shards: int, move: bool) -> DataFrame:
    """``node``, ``class``, ``shard`` after the first round; without ``move`` before it.

    ``class``: magnitude of the links of the node or of its neighbour with most, whichever are more.
    """
    def first(node: str) -> Column:
        return F.pmod(F.xxhash64(node), F.lit(shards)).cast("int")

    degrees = both.groupBy(F.col("a").alias("b")).agg(F.count(F.lit(1)).alias("degree"))
    around = join_wide(both, degrees, "b")
    votes = around.groupBy(F.col("a").alias("node"), first("b").alias("there")).agg(
        F.count(F.lit(1)).alias("votes"), F.max(F.struct("degree", F.col("b").alias("node"))).alias("strongest"))
    best = votes.groupBy("node").agg(
        F.max(F.struct("votes", (-F.col("there")).alias("there"))).alias("best"),
        F.sum("votes").alias("degree"), F.max("strongest").alias("strongest"))
    follows = F.lit(move) & (F.struct("degree", "node") < F.col("strongest"))
    return best.select("node", F.floor(F.log2(F.greatest("degree", "strongest.degree"))).cast("int").alias("class"),
                       F.when(follows, -F.col("best.there")).otherwise(first("node")).alias("shard"))


def _allowed(movers: DataFrame, room: list[int], shards: int) -> list[int]:
    """How many may go each way (from * shards + to): as many as come back, and as many more as the shard has room for.

    One number for each way, shards squared at most, comes to the driver.
    """
    wanted = {row[0]: row[1] for row in movers.groupBy("way").count().collect()}
    left, out = list(room), []
    for way in range(shards * shards):
        source, target = divmod(way, shards)
        want, back = wanted.get(way, 0), wanted.get(target * shards + source, 0)
        more = min(max(0, want - back), left[target])
        left[target] -= more
        out.append(min(want, back) + more)
    return out


def propagate(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``node``, ``key``, ``shard`` of each row of ``nodes`` (node: distinct, key: MD5 text that orders them).

    ``links``: two columns of nodes.  Loops, nulls and repeated links are ignored.  A node may hold much of the links.
    Without rounds documents stay where their own hash puts them, within the quotas.
    """
    total = nodes.count()
    quota, bins = quotas(total, shards), max(1, -(-total // BIN_ROWS))
    a, b = (F.col(c) for c in links.columns)
    pairs = links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(a.alias("a"), b.alias("b"))
    both = durable(pairs.union(pairs.select("b", "a").toDF("a", "b")).distinct())
    # Tables of nodes are joined by key at every size: sent to all tasks, they would pass through the driver's memory.
    state = _within(nodes.join(_gather(both, shards, rounds > 0).hint("merge"), "node"), quota, bins)

    for turn in range(rounds - 1):
        loads = _loads(state, shards)
        room = [q - n for q, n in zip(quota, loads, strict=True)]
        neighbours = join_wide(both, state.select(F.col("node").alias("b"), "shard"), "b")
        votes = neighbours.groupBy(F.col("a").alias("node"), F.col("shard").alias("there")).agg(
            F.count(F.lit(1)).alias("votes"))
        best = votes.join(state.hint("merge"), "node").groupBy("node", "key", "shard").agg(
            F.max(F.struct("votes", (-F.col("there")).alias("there"))).alias("best"),
            F.coalesce(F.sum(F.when(F.col("there") == F.col("shard"), F.col("votes"))), F.lit(0)).alias("own"))
        # Half of those who want to move may, else linked documents would change places with each other.
        movers = _written(best.where((F.col("best.votes") > F.col("own")) & (
            F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0)).select(
            "node", "key", (F.col("shard") * shards - F.col("best.there")).alias("way")))
        allowed = _allowed(movers, room, shards)
        ranked = indexed(movers, ["way"], ["key", "node"], bins_of("key", bins), "_rank")
        accepted = durable(ranked.where(F.col("_rank") < _of(allowed, "way")).select(
            "node", F.pmod("way", F.lit(shards)).cast("int").alias("to")))
        if turn % 2 and not accepted.head(1):
            break
        state = _written(state.join(accepted.hint("merge"), "node", "left").select(
            "node", "key", F.coalesce("to", "shard").alias("shard")))

    room = [q - n for q, n in zip(quota, _loads(state, shards), strict=True)]
    free = _fill(nodes.join(state.select("node").hint("merge"), "node", "left_anti"), ["key", "node"],
                 bins_of("key", bins), room)
    return state.unionByName(free.select("node", "key", "shard"))


def shard_documents(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``df``: the id, size, text_crc32, law, shard, slot, grown_shard.

    Documents of equal text are linked (each to the first of its group).  Law ``rows``: shards hold as equal
    counts as they can; groups stay together unless they are larger than a shard's room.  ``size``: bytes of
    the text plus 8; a null text has none and a CRC of 0, and is equal to an empty one.  ``slot`` numbers a shard's
    rows from 0; ``grown_shard`` is null under this law.  Ids may be null or repeated: rows are placed as rows.
    Other columns are not read; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = durable(df.select(
        F.monotonically_increasing_id().alias("node"), F.col(id_column).alias("_id"),
        spread_key(F.col(id_column)).alias("key"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("crc"), F.unhex(F.sha2(text, 256)).alias("digest")))
    groups = rows.groupBy("digest").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    links = join_wide(rows.select("node", "digest"), groups.select("digest", "leader"), "digest").where(
        "node <> leader").select("node", "leader")
    placed = propagate(rows.select("node", "key"), links, shards, rounds)
    numbered = indexed(rows.drop("key", "digest").join(placed.hint("merge"), "node"), ["shard"], ["key", "node"],
                       bins_of("key", max(1, -(-rows.count() // (BIN_ROWS * shards)))), "slot")
    return numbered.select(F.col("_id").alias(id_column), "size", F.col("crc").alias("text_crc32"),
                           F.lit("rows").alias("law"), "shard", F.col("slot").cast("long"),
                           F.lit(None).cast("int").alias("grown_shard"))
