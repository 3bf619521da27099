"""Near-duplicates of whole texts: MinHash minima in bands, signature and exact verification, components.

Documents with one set of shingles form a class; only one document of a class goes on.  The minima of ``BANDS``
bands file it in buckets.  First every member of a bucket is compared with the bucket's smallest member (a star,
not all pairs), which ties groups of near copies together at once.  Then only buckets whose members still lie in
several components are looked at, blockwise and inside a task: signatures pick the documents that may tie two of
them, their sets join them, and the pairs are confirmed there.  Only links that tie components are written, never
pairs.  All links are confirmed on full sets.

A pair of similarity 0.75 shares no bucket with probability (1 - 0.75^5)^40 = 2e-5.  The signature lets a pair
through from 0.6, five standard deviations below.  A signature is the low byte of each minimum, followed by 32 bits
of each bucket: a pair that meets in several buckets is told by these, not by the bytes, which may agree by chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import durable, hand_back
from codesieve.llm.components import connected_components
from codesieve.llm.exact_dedup import _mask, _word, filter_words
from codesieve.operators.partitioning import join_hot

WORDS = 5
BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
SIMILAR = 75  # per cent
LET_THROUGH = 0.6
BLOCK = 1024
PART = 512
KEPT_WORDS = 150_000

_RANDOM = np.random.default_rng(20_240_607)
_MULTIPLY = _RANDOM.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1)
_ADD = _RANDOM.integers(0, 2**64, HASHES, dtype=np.uint64)
_PLACE = _RANDOM.integers(0, 2**64, WORDS + 1, dtype=np.uint64) | np.uint64(1)
_BAND = _RANDOM.integers(0, 2**64, (BANDS, ROWS + 1), dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """64-bit hashes of words, computed once for each word kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; empty without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.array([_HASHES[word] for word in words], dtype=np.uint64)
    size = min(WORDS, len(words))
    count = len(words) - size + 1
    total = np.repeat(_PLACE[WORDS:] * np.uint64(size), count)
    for i in range(size):
        total += hashes[i:i + count] * _PLACE[i]
    return np.unique(_mixed(total))


def minima(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each universal hash (a x + b, upper half) over a set."""
    low = np.full(HASHES, np.uint64(2**64 - 1), dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        some = shingles[at:at + 512] >> np.uint64(32)
        hashed = np.multiply.outer(_MULTIPLY, some)
        hashed += _ADD[:, None]
        np.minimum(low, hashed.min(axis=1), out=low)
    return low >> np.uint64(32)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART):
            yield batch.slice(at, PART)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        sizes, digests, lows = [], [], []
        for text in batch.column(1):
            found = shingle_set(text.as_py())
            sizes.append(len(found))
            digests.append(blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
            lows.append(minima(found))
        low = np.array(lows, dtype=np.uint64).reshape(-1, BANDS, ROWS)
        buckets = _mixed((low * _BAND[:, :ROWS]).sum(axis=2, dtype=np.uint64) + _BAND[:, ROWS]).view(np.int64)
        signatures = np.hstack([(low & np.uint64(255)).astype(np.uint8).reshape(len(lows), HASHES),
                                buckets.astype("<u4").view(np.uint8)])
        filled = np.array(sizes) > 0
        offsets = pa.array(np.arange(len(lows) + 1, dtype=np.int32) * BANDS)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(sizes, type=pa.int64()), pa.array(digests, type=pa.binary()),
            pa.ListArray.from_arrays(offsets, pa.array(buckets.ravel())),
            pa.array([s.tobytes() if full else None for s, full in zip(signatures, filled, strict=True)],
                     type=pa.binary())], names=["id", "n_shingles", "digest", "buckets", "signature"])
    _HASHES.clear()
    hand_back()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        found = [shingle_set(text.as_py()).tobytes() for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, type=pa.binary())], names=["id", "shingles"])
    _HASHES.clear()
    hand_back()


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= SIMILAR * (len(a) + len(b) - common)


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(-1, HASHES)
                for i in (2, 3))
        keep = (a == b).mean(axis=1) >= LET_THROUGH
        yield batch.select([0, 1]).filter(pa.array(keep))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            keep.append(_similar(*(np.frombuffer(z.as_py(), dtype=np.uint64) for z in (x, y))))
        yield batch.select([0, 1]).filter(pa.array(keep, type=pa.bool_()))


def _candidates(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs of rows (sorted by block) that may tie two components, and their signatures' agreement.

    A pair is looked at in the first band whose bucket it shares, and only if its signatures agree often enough.
    """
    block = rows.groupby(["bucket", "i", "j"], sort=False).ngroup().to_numpy()
    side, parts, band = (rows[c].to_numpy() for c in ("side", "component", "band"))
    stored = np.frombuffer(b"".join(rows["signature"]), dtype=np.uint8).reshape(len(rows), -1)
    signatures = stored[:, :HASHES].reshape(-1, BANDS, ROWS)
    buckets = stored[:, HASHES:].reshape(len(rows), BANDS, -1)
    left, right, likely = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
    for step in range(1, len(rows)):
        x = np.flatnonzero(block[:-step] == block[step:])
        if not len(x):
            break
        x = x[(parts[x] != parts[x + step]) & ((side[x] == 2) | (side[x] != side[x + step]))]
        for at in range(0, len(x), 4096):
            p = x[at:at + 4096]
            same = signatures[p] == signatures[p + step]
            share = same.mean(axis=(1, 2))
            met = same.all(axis=2) & (buckets[p] == buckets[p + step]).all(axis=2)
            good = (share >= LET_THROUGH) & (met.argmax(axis=1) == band[p])
            left.append(p[good])
            right.append(p[good] + step)
            likely.append(share[good])
    return np.concatenate(left), np.concatenate(right), np.concatenate(likely)


def _wanted(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of whole blocks that are in some candidate pair."""
    left, right, _ = _candidates(rows)
    return rows.iloc[np.union1d(left, right)]


def _tied(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of whole blocks that tie components, confirmed on full sets: likeliest pairs first, and no pair whose
    components are tied by then."""
    left, right, share = _candidates(rows)
    nodes, parts = rows["node"].to_numpy(), rows["component"].to_numpy()
    block = rows.groupby(["bucket", "i", "j"], sort=False).ngroup().to_numpy()
    sets = [np.frombuffer(x, dtype=np.uint64) for x in rows["shingles"]]
    parent: dict[tuple, tuple] = {}

    def root(x: tuple) -> tuple:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    out = []
    for k in np.argsort(-share, kind="stable"):
        p, q = left[k], right[k]
        x, y = root((block[p], parts[p])), root((block[q], parts[q]))
        if x != y and _similar(sets[p], sets[q]):
            parent[x] = y
            out.append((nodes[p], nodes[q]))
    return pd.DataFrame(out, columns=["a", "b"])


def _by_block(work):
    """Worker over partitions sorted by block; the last block of a part waits for the next one."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = None
        for batch in batches:
            for at in range(0, len(batch), 2 * BLOCK):
                part = batch.iloc[at:at + 2 * BLOCK]
                rows = part if waiting is None else pd.concat([waiting, part])
                last = (rows[["bucket", "i", "j"]] == rows[["bucket", "i", "j"]].iloc[-1]).all(axis=1).to_numpy()
                waiting = rows[last]
                if not last.all():
                    yield work(rows[~last])
        if waiting is not None and len(waiting):
            yield work(waiting)
        waiting = None
        hand_back()

    return run


def _maybe_in(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``, false only where the id is surely not among ``ids``: a Bloom filter, no shuffle."""
    words, mask = filter_words(ids.count()), _mask(F.col("id"))
    bits = ids.select(_word(F.col("id"), words).alias("_word"), mask.alias("_bits")).groupBy("_word").agg(
        F.bit_or("_bits").alias("_bits"))
    joined = rows.withColumn("_word", _word(F.col("id"), words)).join(F.broadcast(bits), "_word", "left")
    return joined.withColumn("_maybe", F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))).drop(
        "_word", "_bits")


def _only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` whose id is among the distinct ``ids``; most others are left out before any shuffle."""
    near = _maybe_in(rows, ids).where("_maybe").drop("_maybe")
    return near.join(ids, "id")  # not a semi join, which would be moved in front of the filter


class _Linker:
    """Verification of candidate pairs of one corpus."""

    def __init__(self, texts: DataFrame, classes: DataFrame):
        self.texts, self.classes, self.kind = texts, classes, texts.schema["id"].dataType.simpleString()

    def _with_both(self, pairs: DataFrame, values: DataFrame) -> DataFrame:
        name = values.columns[1]
        left = values.select(F.col("id").alias("a"), F.col(name).alias("_x"))
        right = values.select(F.col("id").alias("b"), F.col(name).alias("_y"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", "_x", "_y")

    def alike(self, pairs: DataFrame) -> DataFrame:
        signatures = self.classes.select("id", F.substring("signature", 1, HASHES).alias("signature"))
        return self._with_both(pairs, signatures).mapInArrow(_alike, f"a {self.kind}, b {self.kind}")

    def sets(self, ids: DataFrame) -> DataFrame:
        """``id`` and full set of the texts of ``ids``."""
        return _only(self.texts, durable(ids.distinct())).mapInArrow(_sets, f"id {self.kind}, shingles binary")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs that are similar on full sets; ``pairs`` are stored."""
        sets = self.sets(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))))
        return self._with_both(pairs, sets).mapInArrow(_confirmed, f"a {self.kind}, b {self.kind}")


def _joined_by(components: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: these tie whole components, so that only few edges are left to work on."""
    known = components.select("node", "component")
    edges = (links.join(known.toDF("a", "x"), "a", "left").join(known.toDF("b", "y"), "b", "left")
             .select(F.coalesce("x", "a").alias("u"), F.coalesce("y", "b").alias("v")))
    merged = durable(connected_components(edges))
    every = components.union(merged.select("node", F.col("node").alias("component"))).groupBy("node").agg(
        F.min("component").alias("component"))
    return every.join(merged.toDF("component", "_to"), "component", "left").select(
        "node", F.coalesce("_to", "component").alias("component"))


def _components(linker: _Linker) -> DataFrame:
    """``node``, ``component`` of all classes that confirmed links tie to others."""
    filed = linker.classes.select("id", F.posexplode("buckets").alias("band", "bucket"))
    shared = filed.groupBy("bucket").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = durable(join_hot(filed, shared, "bucket", spread_by=F.xxhash64("id"), salts=4).select(
        "bucket", "band", "n", F.col("id").alias("node"), "leader"))
    stars = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    tested = durable(linker.alike(stars))
    components = durable(connected_components(linker.confirmed(tested)))
    signatures = linker.classes.select(F.col("id").alias("node"), "signature")
    blocks = F.ceil(F.col("n") / F.lit(float(BLOCK))).cast("int")
    own = F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int")
    placed = members.join(components, "node", "left").select(
        "bucket", "band", "n", "node", F.coalesce("component", "node").alias("component"))
    split = placed.groupBy("bucket").agg(
        F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("bucket")
    rest = join_hot(placed, split, "bucket", "left_semi", F.xxhash64("node"), 4)
    # A bucket of many members is compared block by block: each row goes to the pairs of blocks it belongs to.
    spread = (rest.join(signatures, "node").withColumn("blocks", blocks).withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "band",
                      F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0)
                      .otherwise(1).alias("side"), "node", "component", "signature"))
    wanted = durable(_sorted(spread).mapInPandas(
        _by_block(_wanted), f"bucket long, i int, j int, band int, side int, node {linker.kind}, "
                            f"component {linker.kind}, signature binary"))
    if not wanted.head(1):
        return components
    sets = linker.sets(wanted.select(F.col("node").alias("id"))).withColumnRenamed("id", "node")
    links = _sorted(wanted.join(sets, "node")).mapInPandas(_by_block(_tied), f"a {linker.kind}, b {linker.kind}")
    return _joined_by(components, durable(links))


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, n_shingles, component_id (smallest id reachable by links), kept.

    A link: 100 * intersection >= 75 * union of the sets of 5-word shingles (A-Z lower-cased; fewer words: the whole
    sequence).  Texts without words, null and empty ones, have empty sets and no links.  Rows without an id have no
    links either: component_id is null, kept true.  Rows repeated with one id and text are returned as often.  An
    id with several texts has the links of all of them.  Other columns are not read; an empty table gives an empty result.
    """
    texts = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    sketches = durable(texts.mapInArrow(
        _sketch, f"id {kind}, n_shingles long, digest binary, buckets array<long>, signature binary"))
    filled = sketches.where("digest is not null and id is not null")
    first = F.min_by(F.struct("buckets", "signature"), "id")
    classes = durable(filled.groupBy("digest").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"),
                                                   first.alias("_s")).select("digest", "id", "copies", "_s.*"))
    components = _components(_Linker(texts.where("id is not null"), classes))
    named = classes.select("digest", "id", "copies").join(
        components.withColumnRenamed("node", "id"), "id", "left").where("copies > 1 or component is not null").select(
        "digest", F.coalesce("component", "id").alias("component"))
    found = join_hot(sketches.select("id", "n_shingles", "digest"), named, "digest", "left", F.xxhash64("id"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return found.select(F.col("id").alias(id_column), "n_shingles", component.alias("component_id"),
                        component.eqNullSafe(F.col("id")).alias("kept"))


def drop_near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``df`` without the documents that are not the first of their component; columns as they are.

    Rows whose id is surely not among the dropped ones pass without a shuffle.
    """
    found = near_duplicates(df, id_column, text_column)
    gone = durable(found.where("not kept").select(F.col(id_column).alias("id")).distinct())
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(id_column).alias("id"))
    flagged = _maybe_in(rows, gone)
    stay = flagged.where("_maybe").join(gone.withColumn("_gone", F.lit(True)), "id", "left").where("_gone is null")
    return flagged.where("not _maybe").select("_row").union(stay.select("_row")).select("_row.*")
