"""Collocations: suffixes of words, partitioned by prefixes under a memory budget, counted in depth-truncated suffix subtrees.

Every word of a piece starts a suffix, cut to the longest phrase's length.  First the prefixes of one word are counted; those
with more suffixes than the budget are made longer by a word, until they fit or are as long as a phrase.  A prefix lies in a
bucket by its hash, and neighbouring buckets form a group as long as their suffixes fit the budget.  Each group then gets its
suffixes, equal ones as one with a count, and builds its subtree by itself: sorted, the suffixes are the leaves, a node is a
stretch of leaves that begin alike, and its count is their total.  Prefixes that were made longer have theirs from the counting.

What the driver holds is bounded: at most ``MOST_GROUPS`` hashes of prefixes and ``16 * MOST_GROUPS`` totals of buckets; a corpus
of more than ``BUDGET * MOST_GROUPS`` words has a larger budget.  A hash shared by two prefixes only puts both in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codesieve.llm.common import durable, power_of_two
from codesieve.operators.partitioning import join_hot

#: Suffixes of a group, and groups at most (beyond, the budget grows).
BUDGET, MOST_GROUPS = 1 << 20, 1 << 17
#: Words, and different ones, that a task holds before it passes them on.
HELD_WORDS, HELD_DIFFERENT = 1 << 21, 1 << 19
JOINED_BYTES = 1 << 20

_UPPER = bytes(range(65, 91))
_FOLD = bytes.maketrans(_UPPER + b"\t.,;:!?\x0b\x0c\r", _UPPER.lower() + b" " + b"\n" * 9)
_STOP = b"\xff"  # in no UTF-8 text


def pieces_of(text: str | None) -> bytes:
    """Words of a text, A-Z lower-cased, with a sign of its own between pieces."""
    return (text or "").encode().translate(_FOLD).replace(b"\n", b" \xff ")


class _Numbers(dict):
    """Numbers of words from 1; 0 ends a piece."""

    def __init__(self):
        super().__init__({_STOP: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self)
        return value


Held = tuple[str, list[bytes], np.ndarray]  # language, words by number (from 1), the numbers of a text


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[Held]:
    """The numbered words of many texts of one language, in bounded amounts."""
    texts: dict[str, list[bytes]] = {}
    numbers: dict[str, _Numbers] = {}
    codes: dict[str, list[np.ndarray]] = {}
    waiting = size = 0

    def number() -> int:
        added = 0
        for lang, some in texts.items():
            words = _STOP.join([b"", *[b" " + t + b" " for t in some], b""]).split()
            known = numbers.setdefault(lang, _Numbers())
            codes.setdefault(lang, []).append(np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words)))
            added += len(words)
        texts.clear()
        return added

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            data = pieces_of(text.as_py())
            texts.setdefault(lang.as_py(), []).append(data)
            waiting += len(data)
            if waiting >= JOINED_BYTES:
                size, waiting = size + number(), 0
                if size >= HELD_WORDS or sum(map(len, numbers.values())) >= HELD_DIFFERENT:
                    for name, known in numbers.items():
                        yield name, list(known)[1:], np.concatenate(codes[name])
                    numbers, codes, size = {}, {}, 0
    number()
    for name, known in numbers.items():
        yield name, list(known)[1:], np.concatenate(codes[name])


def suffixes(codes: np.ndarray, depth: int) -> np.ndarray:
    """Column d: the d-th word after each word of a text, 0 from the end of its piece on."""
    padded = np.concatenate([codes, np.zeros(depth, dtype=codes.dtype)])
    first = np.flatnonzero(codes)
    out = np.zeros((depth, len(first)), dtype=np.int32)
    out[0] = codes[first]
    for d in range(1, depth):
        out[d] = np.where(out[d - 1] > 0, padded[first + d], 0)
    return out


def combined(rows: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different columns of ``rows`` in order, and how often each occurs."""
    if not rows.shape[1]:
        return rows, np.zeros(0, dtype=np.int64)
    key, values = np.zeros(rows.shape[1], dtype=np.int64), 1
    for row in rows:
        width = int(row.max()) + 1
        if values > (1 << 62) // width:  # too many for a number: go on from the places among those there are
            key = np.unique(key, return_inverse=True)[1]
            values = int(key.max()) + 1
        key, values = key * width + row, values * width
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    amount = np.ones(len(key), dtype=np.int64) if counts is None else counts[order]
    return rows[:, order[starts]], np.add.reduceat(amount, starts)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def _prefixes(lang: str, words: list[bytes], rows: np.ndarray) -> Iterator[np.ndarray]:
    """Hash of the first word of each suffix, then of the first two, and so on."""
    own = np.array([0, *map(xxhash.xxh3_64_intdigest, words)], dtype=np.uint64)
    value = np.full(rows.shape[1], xxhash.xxh3_64_intdigest(lang.encode()), dtype=np.uint64)
    for row in rows:
        value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + own[row])
        yield value


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _strings(words: list[bytes], numbers: np.ndarray) -> pa.Array:
    return pa.array(words, type=pa.binary()).cast(pa.string()).take(pa.array(numbers - 1))


def _phrases(words: list[bytes], rows: np.ndarray) -> pa.Array:
    """Words of each column joined by a space."""
    parts = [_strings(words, row) for row in rows]
    return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, " ")


class _Partition:
    """Which prefixes are made longer, by depth, and the group of each bucket."""

    def __init__(self, budget: int, buckets: int):
        self.budget, self.buckets = budget, buckets
        self.longer: list[np.ndarray] = []
        self.totals = np.zeros(buckets, dtype=np.float64)
        self.groups = np.zeros(buckets, dtype=np.int64)

    def pack(self) -> None:
        """Neighbouring buckets form a group as long as they fit the budget."""
        group, used = 0, 0.0
        for bucket, total in enumerate(self.totals.tolist()):
            if used and used + total > self.budget:
                group, used = group + 1, 0.0
            used += total
            self.groups[bucket] = group

    def place(self, lang: str, words: list[bytes], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length of the prefix that each suffix belongs to, and its group."""
        depth = np.ones(rows.shape[1], dtype=np.int64)
        kept = np.zeros(rows.shape[1], dtype=np.uint64)
        for d, value in enumerate(_prefixes(lang, words, rows), 1):
            kept = np.where(depth == d, value, kept)
            if d <= len(self.longer) and d < len(rows):
                depth += (depth == d) & _among(value, self.longer[d - 1])
        return depth, self.groups[(kept % np.uint64(self.buckets)).astype(np.int64)]


def _prefix_counts(texts: DataFrame, depth: int, longer: list[np.ndarray]) -> DataFrame:
    """``lang``, ``phrase``, ``f`` of the prefixes of one length whose shorter prefixes are all made longer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, codes in _held(batches):
            rows = suffixes(codes, depth)
            rows = rows[:, rows[-1] > 0]
            wanted = np.ones(rows.shape[1], dtype=bool)
            for value, ordered in zip(_prefixes(lang, words, rows[:-1]), longer, strict=True):
                wanted &= _among(value, ordered)
            rows, counts = combined(rows[:, wanted])
            if len(counts):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), type=pa.string()), _phrases(words, rows),
                                                  pa.array(counts)], names=["lang", "phrase", "f"])

    return texts.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _weighed(counts: DataFrame, part: _Partition) -> DataFrame:
    """``bucket`` and the suffixes in it of the prefixes that fit; those that do not come with a hash instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.array([_hash_of(lang, phrase) for lang, phrase in
                               zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column(2)], names=["hash", "f"])

    hashed = counts.mapInArrow(run, "hash long, f long")
    over = F.col("f") > part.budget
    bucket = F.pmod(F.col("hash"), F.lit(part.buckets))  # a power of two: the same as of the unsigned hash
    return hashed.select(F.when(over, F.col("hash")).alias("hash"), F.when(~over, bucket).alias("bucket"), "f").groupBy(
        "hash", "bucket").agg(F.sum("f").alias("f"))


def _hash_of(lang: str, phrase: str) -> int:
    words = phrase.encode().split(b" ")
    rows = np.arange(1, len(words) + 1, dtype=np.int32)[:, None]
    return int(list(_prefixes(lang, words, rows))[-1][0])


def _partition(texts: DataFrame, words: DataFrame, total: int, longest: int, budget: int) -> tuple[_Partition, DataFrame]:
    """Groups under the budget, and the counts of the prefixes that were made longer (and all words)."""
    budget = max(budget, -(-total // MOST_GROUPS))
    part = _Partition(budget, power_of_two(16 * max(1, total / budget)))
    counts, known = words, words
    for depth in range(1, longest):
        weights = durable(_weighed(counts, part)).toPandas()  # bounded by buckets and long prefixes
        fits = weights["hash"].isna()
        np.add.at(part.totals, weights.loc[fits, "bucket"].astype(np.int64), weights.loc[fits, "f"].to_numpy())
        part.longer.append(np.sort(weights.loc[~fits, "hash"].astype(np.int64).to_numpy().view(np.uint64)))
        if fits.all():
            break
        if depth + 1 < longest:
            counts = durable(_prefix_counts(texts, depth + 1, part.longer))
            known = known.union(counts.where(F.col("f") > budget))
        else:  # their suffixes are single leaves, spread over all buckets
            part.totals += weights.loc[~fits, "f"].sum() / part.buckets
    part.pack()
    return part, known


def _grouped_suffixes(texts: DataFrame, part: _Partition, longest: int) -> DataFrame:
    """Suffixes of each group in parts: ``grp``, ``lang``, ``depth`` of their prefix, their words, numbers and counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, codes in _held(batches):
            rows, counts = combined(suffixes(codes, longest))
            depth, group = part.place(lang, words, rows)
            order = np.lexsort((depth, group))
            starts = np.flatnonzero(np.concatenate([[True], np.diff(group[order] * 64 + depth[order]) != 0]))
            for at, end in zip(starts, [*starts[1:], len(order)], strict=True):
                some = order[at:end]
                used, numbers = np.unique(rows[:, some], return_inverse=True)
                numbers = numbers.reshape(longest, -1).astype(np.int32)
                if used[0] != 0:  # 0 stays the end of a piece
                    numbers = numbers + 1
                own = b" ".join([words[i - 1] for i in used.tolist() if i])
                packed = [pa.compress(data, codec="zstd", asbytes=True) for data in
                          (own, numbers.tobytes(), counts[some].astype(np.int64).tobytes())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(group[some[0]])], type=pa.int64()), pa.array([lang], type=pa.string()),
                    pa.array([int(depth[some[0]])], type=pa.int64()), pa.array([len(some)], type=pa.int64()),
                    pa.array([len(own)], type=pa.int64()), *[pa.array([data], type=pa.binary()) for data in packed]],
                    names=["grp", "lang", "depth", "suffixes", "bytes", "words", "numbers", "counts"])

    return texts.mapInArrow(run, "grp long, lang string, depth long, suffixes long, bytes long, words binary, "
                                 "numbers binary, counts binary")


def subtree(rows: np.ndarray, counts: np.ndarray, least: int, from_depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Nodes of the subtree over suffixes: per depth the phrases (columns) that occur ``least`` times, and their counts."""
    leaves, totals = combined(rows, counts)
    new = np.zeros(leaves.shape[1], dtype=bool)
    new[:1] = True
    for depth, row in enumerate(leaves, 1):
        new[1:] |= row[1:] != row[:-1]  # a node begins where a leaf differs from the one before in the words so far
        starts = np.flatnonzero(new)
        if depth >= from_depth and len(starts):
            total = np.add.reduceat(totals, starts)
            good = (total >= least) & (row[starts] > 0)
            yield leaves[:depth, starts[good]], total[good]


def _nodes(least: int, longest: int) -> Callable:
    """Worker over parts sorted by group: builds one subtree per group, language and depth of prefix."""
    def build(key: tuple, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = {}
        rows, counts = [], []
        for suffix_count, size, own, packed, amounts in parts:
            words = pa.decompress(own, size, codec="zstd", asbytes=True).split(b" ") if size else []
            places = np.array([0, *[numbers.setdefault(word, len(numbers) + 1) for word in words]], dtype=np.int32)
            data = pa.decompress(packed, 4 * longest * suffix_count, codec="zstd", asbytes=True)
            rows.append(places[np.frombuffer(data, dtype=np.int32).reshape(longest, -1)])
            counts.append(np.frombuffer(pa.decompress(amounts, 8 * suffix_count, codec="zstd", asbytes=True), dtype=np.int64))
        words = list(numbers)
        for found, total in subtree(np.concatenate(rows, axis=1), np.concatenate(counts), least, max(2, key[2])):
            if len(total):
                yield pa.RecordBatch.from_arrays([pa.array([key[1]] * len(total), type=pa.string()), _phrases(words, found),
                                                  pa.array(total)], names=["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                values = [batch.column(i)[row].as_py() for i in range(8)]
                if tuple(values[:3]) != key:
                    if parts:
                        yield from build(key, parts)
                    key, parts = tuple(values[:3]), []
                parts.append(tuple(values[3:]))
        if parts:
            yield from build(key, parts)

    return run


def _length(phrase: str) -> Column:
    return F.size(F.split(F.col(phrase), " "))


def phrase_counts(df: DataFrame, longest: int, least: int, lang_column: str = "lang", text_column: str = "text",
                  budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """Counts (``lang``, ``phrase``, ``f``) of all words, and of all phrases of 2 to ``longest`` words that occur ``least`` times."""
    texts = df.select(F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"),
                      F.col(text_column).cast("string").alias("text"))
    words = durable(_prefix_counts(texts, 1, []))
    total = words.agg(F.sum("f")).first()[0] or 0
    part, known = _partition(texts, words, total, longest, budget)
    parts = _grouped_suffixes(texts, part, longest).repartition("grp").sortWithinPartitions("grp", "lang", "depth")
    nodes = parts.mapInArrow(_nodes(least, longest), "lang string, phrase string, f long")
    made_longer = known.where((_length("phrase") > 1) & (F.col("f") >= least))
    return words, durable(nodes.union(made_longer))


def collocations(df: DataFrame, longest: int = 3, least: int = 10, most: int = 2000, overlap_percent: int = 50,
                 lang_column: str = "lang", text_column: str = "text", budget: int = BUDGET) -> DataFrame:
    """The first ``most`` phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    Words are folded from A-Z to a-z; pieces end at ``.,;:!?`` and line ends, words at spaces and tabs.  A phrase of 2 to
    ``longest`` words that occurs a >= ``least`` times is cut where 10^6 a^2 / (l r) is lowest (first of such cuts), l and r being how
    often its parts occur.  Phrases inside a longer one that occurs ``overlap_percent`` of a times are left out.  Order: score, then a
    (both descending), then the phrase's bytes.  A null language is ``und``; null and empty texts have no words; other columns are not
    read; an empty table gives an empty result.
    """
    words, nodes = phrase_counts(df, longest, least, lang_column, text_column, budget)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    counts = words.where(F.col("f") >= least).union(nodes)
    split = F.split("phrase", " ")

    def part_of(first: Column, size: Column) -> Column:
        return F.array_join(F.slice(split, first, size), " ")

    cuts = nodes.withColumn("k", F.explode(F.sequence(F.lit(1), _length("phrase") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k", part_of(F.lit(1), F.col("k")).alias("first"),
        part_of(F.col("k") + 1, F.size(split) - F.col("k")).alias("rest"))
    both = join_hot(cuts, counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"],
                    spread_by=F.xxhash64("phrase"), salts=4)
    both = join_hot(both, counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"],
                    spread_by=F.xxhash64("phrase"), salts=4)
    # Decimals of 38 digits: exact up to 10^16 words.
    score = F.expr("(cast(1000000 as decimal(7,0)) * a * a) div (cast(l as decimal(19,0)) * r)")
    lowest = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size(split) - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.size(split) - size + 1), lambda first: part_of(first, size))))
    inside = nodes.where(_length("phrase") > 2).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "f").groupBy(
        "lang", "phrase").agg(F.max("f").alias("longer"))
    kept = lowest.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < overlap_percent * F.col("a")))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", rank).where(F.col("rank") <= most)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
