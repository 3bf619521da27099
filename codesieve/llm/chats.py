"""Reply trees as conversations for training; DataFrame functions only.

Messages know the message they answer.  Iterative self-joins follow the replies upwards, twice as far each round, and add
up rows, characters and scores on the way, so that a chain of n messages takes log2(n) joins.  Every leaf is a branch; the
best of each tree are chosen by their mean score, and the jumps of the rounds, taken in turn, list their messages.  Up to
there only ids and numbers move, in joins with one row per message on one side, which adaptive execution splits where a message has
very many answers; texts move once, to their tree, where every chosen branch becomes one conversation.

A turn is written as ``### role:``, a line end, the text, ``</turn>`` and a line end.  Control strings inside texts and
roles are written as ``\\0;`` (a backslash), ``\\1;`` (the opening), ``\\2;`` (the closing) and, in roles, ``\\3;`` (a line
end).  No backslash is left as it was, so that every one begins such a mark and reading back is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codesieve.llm.common import durable, indexed

OPENING, CLOSING = "###", "</turn>"
HEAD, HEAD_END, END = f"{OPENING} ", ":\n", f"{CLOSING}\n"
MARKS = [("\\", "\\0;"), (OPENING, "\\1;"), (CLOSING, "\\2;")]
ROLE_MARKS = [*MARKS, ("\n", "\\3;")]
#: Turn numbers that are numbered together in one task.
BIN = 512


def escaped(text: Column, marks=MARKS) -> Column:
    """Text without control strings."""
    for control, mark in marks:
        text = F.replace(text, F.lit(control), F.lit(mark))
    return text


def unescaped(text: Column, marks=MARKS) -> Column:
    """The text that was ``escaped``."""
    for control, mark in reversed(marks):
        text = F.replace(text, F.lit(mark), F.lit(control))
    return text


def _rows(df: DataFrame, tree: str, role: str, text: str, score: str | None, **more: Column) -> DataFrame:
    """One row per message: ``tree``, what is written, its size and where its text lies in it; ``key`` tells it apart."""
    said = F.coalesce(F.col(role).cast("string"), F.lit(""))
    head = F.concat(F.lit(HEAD), escaped(said, ROLE_MARKS), F.lit(HEAD_END))
    body = escaped(F.coalesce(F.col(text).cast("string"), F.lit("")))
    value = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    rows = df.select(F.col(tree).alias("tree"), said.alias("role"), F.concat(head, body, F.lit(END)).alias("written"),
                     F.length(head).cast("long").alias("head"), value.alias("score"),
                     *[column.alias(name) for name, column in more.items()])
    told = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("written", "score", *more)]
    return rows.withColumn("size", F.length("written").cast("long")).withColumn(
        "key", F.md5(F.concat_ws("\x00", *told)))


def _structure(rows: DataFrame, *more: str) -> DataFrame:
    """One row per message without its text; equal messages are one, ``copies`` tells how many."""
    return rows.groupBy("tree", "key", *more).agg(F.count(F.lit(1)).alias("copies"), F.max("size").alias("size"),
                                                  F.max("score").alias("score"))


def _roads(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Per node what lies on its way from the root, itself included, and the jumps of 1, 2, 4, ... messages upwards.

    ``nodes``: tree, node, up, copies, size, score.  Nodes that never come to a root (on or below a circle) are left out.
    """
    state = durable(nodes.select("tree", "node", "up", F.col("copies").alias("rows"),
                                 (F.col("copies") * F.col("size")).alias("chars"),
                                 (F.col("copies") * F.col("score")).alias("total")))
    jumps = []
    for _ in range(2 + math.ceil(math.log2(max(2, state.count())))):
        active = state.where("up is not null")
        if not active.head(1):
            break
        jumps.append(active.select("tree", "node", "up"))
        above = state.select("tree", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("rows").alias("_rows"),
                             F.col("chars").alias("_chars"), F.col("total").alias("_total"))
        further = active.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("_up").alias("up"), (F.col("rows") + F.col("_rows")).alias("rows"),
            (F.col("chars") + F.col("_chars")).alias("chars"), (F.col("total") + F.col("_total")).alias("total"))
        state = durable(state.where("up is null").union(further))
    return state.where("up is null").drop("up"), jumps


def _branches(nodes: DataFrame, most: int) -> DataFrame:
    """The messages of the best branches of each tree: ``tree``, ``branch`` (from 1), ``mean``, ``key``, ``copies``, how many
    rows and characters are ``before`` it."""
    roads, jumps = _roads(nodes)
    answered = nodes.where("up is not null").select("tree", F.col("up").alias("node")).distinct()
    leaves = roads.join(answered, ["tree", "node"], "left_anti").withColumn("mean", F.col("total") / F.col("rows"))
    best = W.partitionBy("tree").orderBy(F.desc("mean"), F.desc("rows"), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= most)
    found = durable(chosen.select("tree", "branch", "mean", "node"))
    for jump in reversed(jumps):
        further = found.join(jump, ["tree", "node"]).select(
            "tree", "branch", "mean", F.col("up").alias("node"))
        found = durable(found.union(further))
    places = nodes.select("tree", "node", "key", "copies", "size").join(
        roads.select("tree", "node", "rows", "chars"), ["tree", "node"])
    return found.join(places, ["tree", "node"]).select(
        "tree", "branch", "mean", "key", "copies", "size", (F.col("rows") - F.col("copies")).alias("rows_before"),
        (F.col("chars") - F.col("copies") * F.col("size")).alias("before"))


def _conversations(rows: DataFrame, branches: DataFrame, learned: str) -> DataFrame:
    """One row per branch.  Both inputs are dealt by tree, once; what follows keeps that dealing."""
    place = F.struct("branch", "mean", "rows_before", "before", "copies")
    both = rows.select("tree", "key", "written", "role", "head", "size", F.lit(None).cast(
        branches.select(place.alias("p")).schema["p"].dataType).alias("place")).unionByName(
        branches.select("tree", "key", place.alias("place")), allowMissingColumns=True).repartition("tree")
    turns = both.groupBy("tree", "key").agg(
        F.max("written").alias("written"), F.max("role").alias("role"), F.max("head").alias("head"),
        F.max("size").alias("size"), F.collect_list("place").alias("places"))
    placed = turns.withColumn("at", F.explode("places")).select("tree", "at.branch", "at.mean", F.struct(
        "at.rows_before", "at.before", "at.copies", "written", "role", "head", "size").alias("turn"))
    whole = placed.groupBy("tree", "branch", "mean").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def spans(turn: Column) -> Column:
        """Where the text of each copy of a turn lies, if it is learned."""
        def of(k: Column) -> Column:
            start = turn["before"] + k * turn["size"]
            return F.struct((turn["rows_before"] + k).alias("turn"), start.alias("turn_start"),
                            (start + turn["head"]).alias("start"), (start + turn["size"] - len(END)).alias("end"))

        copies = F.transform(F.sequence(F.lit(0).cast("long"), turn["copies"] - 1), of)
        return F.when(turn["role"] == learned, copies).otherwise(F.slice(copies, 1, 0))

    written = F.transform("turns", lambda t: F.array_repeat(t["written"], t["copies"].cast("int")))
    return whole.select("tree", "branch", F.col("mean").alias("score"),
                        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["copies"]).alias("n_turns"),
                        F.array_join(F.flatten(written), "").alias("formatted"),
                        F.flatten(F.transform("turns", spans)).alias("loss_spans"))


def format_trees(df: DataFrame, tree: str = "tree_id", message: str = "message_id", parent: str = "parent_id",
                 role: str = "role", text: str = "text", score: str | None = "score", branches: int = 1,
                 learned: str = "assistant") -> DataFrame:
    """The best ``branches`` of every reply tree: tree, branch (from 1), score, n_turns, formatted, loss_spans.

    A branch leads from a message that answers none (or one that is not there) to one without answers.  Branches with the
    higher mean score come first, then longer ones.  ``loss_spans`` has, for each turn whose role is ``learned``, the
    number of the turn, the character (code point) its turn starts at, and where its text starts and ends in ``formatted``.

    Null texts and roles are empty, null scores 0, a null tree is a tree of its own.  A message without an id has no answers.  Messages alike in
    all columns that are read are written one after the other.  Of different messages with one id the one with the smallest digest
    has the answers, the others have none.  Messages on or below a circle of answers belong to no branch.  Other columns are
    not read; an empty table gives an empty result.  A conversation is one row and has to fit into a task.
    """
    rows = _rows(df, tree, role, text, score, message=F.col(message).cast("string"), parent=F.col(parent).cast("string"))
    rows = rows.withColumn("tree", _named(rows["tree"]))
    structure = durable(_structure(rows, "message", "parent"))
    answered = structure.where("message is not null").groupBy("tree", F.col("message").alias("parent")).agg(
        F.min("key").alias("up"))
    nodes = durable(structure.join(answered, ["tree", "parent"], "left").select(
        "tree", F.col("key").alias("node"), "up", "key", "copies", "size", "score"))
    return _restored(_conversations(rows, _branches(nodes, branches), learned), df, tree)


def format_turns(df: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 learned: str = "assistant") -> DataFrame:
    """Conversations given as rows with turn numbers, as ``format_trees`` returns them: each turn answers the one before.

    Rows of one turn follow each other by a digest of role and text; a null turn comes first.
    """
    rows = _rows(df, tree, role, text, None, turn=F.col(turn))
    rows = rows.withColumn("tree", _named(rows["tree"]))
    part = F.coalesce(F.floor(F.col("turn") / BIN), F.lit(-(1 << 60)))
    numbered = indexed(_structure(rows, "turn"), ["tree"], ["turn", "key"], part, "node")
    nodes = durable(numbered.select("tree", "node", F.when(F.col("node") > 0, F.col("node") - 1).alias("up"), "key",
                                    "copies", "size", "score"))
    return _restored(_conversations(rows, _branches(nodes, 1), learned), df, tree)


def _named(tree: Column) -> Column:
    """Tree as text that joins like any other value; null has a text of its own."""
    return F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("null"))


def _restored(found: DataFrame, df: DataFrame, tree: str) -> DataFrame:
    name = F.when(F.col("tree") != "null", F.substring("tree", 2, 1 << 30))
    return found.withColumn("tree", name.cast(df.schema[tree].dataType)).withColumnRenamed("tree", tree)


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    return F.transform(_pieces(formatted), lambda turn: F.struct(
        unescaped(F.substring_index(turn, HEAD_END, 1).substr(F.lit(len(HEAD) + 1), F.length(turn)), ROLE_MARKS).alias("role"),
        unescaped(turn.substr(F.locate("\n", turn) + 1, F.length(turn))).alias("text")))


def learned_texts(formatted: Column, spans: Column) -> Column:
    """The texts that lie under the loss mask, as they were before escaping."""
    turns = _pieces(formatted)
    return F.transform(spans, lambda s: unescaped(F.get(turns, s["turn"].cast("int")).substr(
        (s["start"] - s["turn_start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


def _pieces(formatted: Column) -> Column:
    """Turns as written, each without its end; the last end is followed by nothing."""
    pieces = F.split(formatted, END)
    return F.slice(pieces, 1, F.size(pieces) - 1)
