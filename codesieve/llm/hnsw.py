"""Nearest neighbours by a hierarchical navigable small-world graph per shard; shard results are merged.

Vectors are dealt to shards of about ``SHARD_ROWS``.  Each shard's graph is stored as one row of flat arrays: the
vectors, for every layer the members and a table of neighbours (so many a node, -1 where there are fewer), and the
entry node.  Queries go in blocks to every shard; each shard returns its nearest for each query, and the nearest of all
shards remain.  Equal vectors are one node; a node carries as many of the smallest ids as a query can need.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codesieve.llm.common import durable

#: Links of a node on a layer (twice as many on the lowest), and nodes kept in view while building and searching.
LINKS, BUILD_VIEW, SEARCH_VIEW = 16, 80, 128
SHARD_ROWS = 8192
QUERY_BLOCK = 2048
GRAPH = "dim int, shard int, size int, vectors binary, entry int, layers array<struct<members: binary, links: binary>>"


class Graph:
    """Graph over the rows of a matrix (float32); distances are squared Euclidean."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], members: list[np.ndarray], entry: int):
        self.vectors, self.links, self.members, self.entry = vectors, links, members, entry
        self.norms = np.einsum("ij,ij->i", vectors, vectors)
        self.places = [None] + [self._place(m) for m in members[1:]]

    def _place(self, members: np.ndarray) -> np.ndarray:
        place = np.full(len(self.vectors), -1, dtype=np.int32)
        place[members] = np.arange(len(members))
        return place

    def neighbours(self, node: int, layer: int) -> np.ndarray:
        row = self.links[layer][node if layer == 0 else self.places[layer][node]]
        return row[:np.searchsorted(row < 0, True)]

    def distances(self, query: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return self.norms[nodes] - 2.0 * (self.vectors[nodes] @ query)

    def look(self, query: np.ndarray, start: list[tuple[float, int]], view: int, layer: int) -> list[tuple[float, int]]:
        """The ``view`` nearest nodes found on a layer, nearest first; distances lack the query's own norm."""
        seen = np.zeros(len(self.vectors), dtype=bool)
        seen[[node for _, node in start]] = True
        near = list(start)
        heapify(near)
        best = [(-d, node) for d, node in start]
        heapify(best)
        while near:
            distance, node = heappop(near)
            if distance > -best[0][0] and len(best) >= view:
                break
            new = self.neighbours(node, layer)
            new = new[~seen[new]]
            if not len(new):
                continue
            seen[new] = True
            found = self.distances(query, new)
            if len(best) >= view:
                good = found < -best[0][0]
                new, found = new[good], found[good]
            for d, n in zip(found.tolist(), new.tolist(), strict=True):
                if len(best) < view:
                    heappush(best, (-d, n))
                elif d < -best[0][0]:
                    heapreplace(best, (-d, n))
                else:
                    continue
                heappush(near, (d, n))
        return sorted((-d, n) for d, n in best)

    def search(self, query: np.ndarray, view: int) -> list[int]:
        """Nodes near a query, nearest first."""
        at = [(float(self.distances(query, np.array([self.entry]))[0]), self.entry)]
        for layer in range(len(self.links) - 1, 0, -1):
            at = self.look(query, at, 1, layer)
        return [node for _, node in self.look(query, at, view, 0)]


def _spread(vectors: np.ndarray, candidates: list[tuple[float, int]], norms: np.ndarray, most: int) -> list[int]:
    """Neighbours in different directions: a candidate nearer to a chosen one than to the node waits; gaps are filled."""
    nodes = [n for _, n in candidates]
    matrix = vectors[nodes]
    between = norms[nodes][:, None] + norms[nodes][None, :] - 2.0 * (matrix @ matrix.T)
    chosen: list[int] = []
    nearest = np.full(len(nodes), np.inf)
    for k, (distance, _) in enumerate(candidates):
        if nearest[k] > distance:
            chosen.append(k)
            if len(chosen) == most:
                break
            np.minimum(nearest, between[k], out=nearest)
    for k in range(len(nodes)):
        if len(chosen) == most:
            break
        if k not in chosen:
            chosen.append(k)
    return [nodes[k] for k in chosen]


def build(vectors: np.ndarray, seed: int = 7) -> Graph:
    """Insert the rows one by one, as drawn levels say."""
    count = len(vectors)
    levels = np.floor(-np.log(1.0 - np.random.default_rng(seed).random(count)) / np.log(LINKS)).astype(int)
    top = int(levels.max())
    members = [np.flatnonzero(levels >= layer) for layer in range(top + 1)]
    widths = [2 * LINKS] + [LINKS] * top
    links = [np.full((len(m), w), -1, dtype=np.int32) for m, w in zip(members, widths, strict=True)]
    graph = Graph(vectors, links, members, 0)
    norms, reached = graph.norms, int(levels[0])
    used = [np.zeros(len(m), dtype=np.int32) for m in members]
    for node in range(1, count):
        query, level = vectors[node], int(levels[node])
        at = [(float(graph.distances(query, np.array([graph.entry]))[0]), graph.entry)]
        for layer in range(reached, level, -1):
            at = graph.look(query, at, 1, layer)
        for layer in range(min(reached, level), -1, -1):
            at = graph.look(query, at, BUILD_VIEW, layer)
            real = [(d + float(norms[node]), n) for d, n in at]
            chosen = _spread(vectors, real, norms, LINKS)
            row = node if layer == 0 else graph.places[layer][node]
            links[layer][row, :len(chosen)] = chosen
            used[layer][row] = len(chosen)
            for other in chosen:
                place = other if layer == 0 else graph.places[layer][other]
                if used[layer][place] < widths[layer]:
                    links[layer][place, used[layer][place]] = node
                    used[layer][place] += 1
                else:
                    around = np.append(links[layer][place], node)
                    distance = norms[other] + graph.distances(vectors[other], around)
                    order = np.argsort(distance, kind="stable")
                    kept = _spread(vectors, [(float(distance[k]), int(around[k])) for k in order], norms, widths[layer])
                    links[layer][place, :len(kept)] = kept
        if level > reached:
            graph.entry, reached = node, level
    return graph


def usable(column: str):
    """Vector without nulls and non-finite parts, not empty and not all zero."""
    values = F.col(column)
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return values.isNotNull() & (F.size(values) > 0) & finite & F.exists(values, lambda x: x != 0)


def _build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row of flat arrays for each shard; rows come sorted by shard, and only one shard is held at a time."""
    key, held = None, []

    def finished():
        vectors = np.array(held, dtype=np.float32)
        graph = build(vectors)
        layers = [{"members": m.astype(np.int32).tobytes(), "links": x.tobytes()}
                  for m, x in zip(graph.members, graph.links, strict=True)]
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "size": [len(vectors)],
                             "vectors": [vectors.tobytes()], "entry": [graph.entry], "layers": [layers]})

    for batch in batches:
        for dim, shard, vector in zip(batch["dim"], batch["shard"], batch["vector"], strict=True):
            if (dim, shard) != key:
                if held:
                    yield finished()
                key, held = (dim, shard), []
            held.append(vector)
    if held:
        yield finished()


def shard_counts(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> dict[int, int]:
    """Shards for each length of vectors (one row for each length comes to the driver)."""
    return {row[0]: -(-row[1] // shard_rows) for row in vectors.groupBy(F.size("vector")).count().collect()}


def build_index(vectors: DataFrame, shards: dict[int, int]) -> DataFrame:
    """Graphs of distinct vectors (column ``vector``, array of float), one row for each length of vectors and shard."""
    if not shards:
        return vectors.sparkSession.createDataFrame([], GRAPH)
    count = F.create_map(*[F.lit(x) for item in shards.items() for x in item])[F.size("vector")]
    dealt = vectors.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), count).cast("int").alias("shard"),
                           "vector")
    return dealt.repartition(sum(shards.values()), "dim", "shard").sortWithinPartitions(
        "dim", "shard", F.xxhash64("vector")).mapInPandas(_build, GRAPH)


def _search(nearest: int, view: int):
    """Worker: each row holds a graph and a block of queries; gives node vectors near each query."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                vectors = np.frombuffer(row.vectors, dtype=np.float32).reshape(row.size, row.dim)
                members = [np.frombuffer(x["members"], dtype=np.int32) for x in row.layers]
                links = [np.frombuffer(x["links"], dtype=np.int32).reshape(len(m), -1)
                         for x, m in zip(row.layers, members, strict=True)]
                graph = Graph(vectors, links, members, row.entry)
                wide = vectors.astype(np.float64)
                ids, found, scores = [], [], []
                for query, vector in zip(row.queries, row.query_vectors, strict=True):
                    vector = np.asarray(vector, dtype=np.float32)
                    near = np.array(graph.search(vector, view))
                    exact = np.sqrt(((wide[near] - vector.astype(np.float64)) ** 2).sum(axis=1))
                    order = np.argsort(exact, kind="stable")[:nearest]
                    ids += [query] * len(order)
                    found += [vectors[n] for n in near[order]]
                    scores += exact[order].tolist()
                yield pd.DataFrame({"query_id": ids, "vector": found, "score": scores})

    return run


def nearest_neighbours(df: DataFrame, queries: DataFrame, nearest: int = 10, id_column: str = "vec_id",
                       vector_column: str = "embedding", view: int = SEARCH_VIEW,
                       shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank (from 1), the id, score: for each row of ``queries`` the nearest rows of ``df`` but itself.

    ``queries`` has the columns of ``df``.  Nearness is Euclidean distance on the given vectors, in double precision;
    ties go to the smaller id.  Vectors that are null, empty or zero, or hold null or non-finite parts, take no part,
    nor do rows without an id; vectors of different lengths are not compared.  With fewer candidates all that are
    found are returned.  An id that occurs with several vectors is as near as the nearest; a row repeated counts
    once.  Other columns are not read; an empty table gives an empty result.
    """
    def cleaned(rows: DataFrame) -> DataFrame:
        return rows.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<float>").alias("vector")).where(
            F.col("id").isNotNull() & usable("vector")).distinct()

    items = durable(cleaned(df))
    kind = items.schema["id"].dataType.simpleString()
    # A query needs no more than so many of the smallest ids of a vector, itself left out.
    first = items.withColumn("_n", F.row_number().over(W.partitionBy("vector").orderBy("id"))).where(
        F.col("_n") <= nearest + 1).drop("_n")
    distinct = durable(first.select("vector").distinct())
    shards = shard_counts(distinct, shard_rows)
    graphs = durable(build_index(distinct, shards))
    asked = durable(cleaned(queries).where(F.size("vector").isin(list(shards))))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    packed = dealt.groupBy(F.size("vector").alias("dim"), "block").agg(  # about QUERY_BLOCK queries in a block
        F.collect_list(F.struct("id", "vector")).alias("q"))
    count = F.create_map(*[F.lit(x) for item in (shards or {0: 0}).items() for x in item])[F.col("dim")]
    sent = packed.select("dim", F.explode(F.sequence(F.lit(0), count - 1)).alias("shard"),
                         F.col("q.id").alias("queries"), F.col("q.vector").alias("query_vectors"))
    pairs = sent.join(graphs, ["dim", "shard"]).repartition(max(1, blocks * sum(shards.values())))
    near = pairs.mapInPandas(_search(nearest + 1, view), f"query_id {kind}, vector array<float>, score double")
    candidates = near.join(first, "vector").where("id <> query_id").groupBy("query_id", "id").agg(
        F.min("score").alias("score"))
    order = W.partitionBy("query_id").orderBy("score", "id")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select(
        "query_id", F.col("rank").cast("int"), F.col("id").alias(id_column), "score")
