"""Periodic runs of words: tiles per octave of periods, solved one by one with Z-functions, stitched per document and period.

A run is a stretch of words with smallest period q that repeats at least ``EXPONENT`` times, has ``LEAST`` words or more, and
is not continued by a neighbouring word.  Word i *matches* at distance q if word i + q is the same; a run of period q is a
stretch of ``needed(q)`` matches or more.  For the periods of an octave (lo to 2 lo - 1) boundaries are set every
``needed(lo)`` words, so that every run holds one, and the tile of a boundary reaches that far to both sides, and a period
more to the right.  The Z-function of the words after the boundary tells how far they match at each period, that of the
reversed words how far those before it do.  Tiles where no pair of words matches for long enough on either side of the
boundary are told by comparing arrays first, eight words deep, for all tiles of many documents at once.

A document's tiles are solved in the task that reads it, or, if it is longer than ``IN_PLACE`` words, sent in bundles to many
tasks.  Only stretches of matches are shuffled, by document and period, where overlapping and touching ones are stitched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codesieve.llm.common import durable

LEAST, EXPONENT = 6, 4
#: Words of a document whose tiles are solved where it is read; words of a bundle of tiles; words worked on together.
IN_PLACE = 1 << 17
BUNDLE = 1 << 16
SLICE = 1 << 18
PAIRS = 1 << 20
DEEP = 8

Stretch = tuple[int, int, int]  # period, first match, end of the matches


def needed(period: int) -> int:
    """Matches in a row that make a run."""
    return max(LEAST - period, (EXPONENT - 1) * period)


def octaves(words: int) -> Iterator[int]:
    """Smallest period of each octave that a document of so many words can hold."""
    lo = 1
    while max(LEAST, EXPONENT * lo) <= words:
        yield lo
        lo *= 2


def z_function(s: list[int]) -> list[int]:
    """Length of the longest common prefix of ``s`` and each of its ends."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def solve_tile(before: list[int], after: list[int], lo: int) -> list[Stretch]:
    """Stretches of matches around a boundary, per period of an octave: places relative to the boundary.

    A stretch counts if the tile holds ``needed(lo)`` of its matches, as every run's stretch around its boundary does.
    """
    reach = needed(lo)
    most = min(2 * lo - 1, len(after))
    forward = z_function(after)
    backward = z_function([*before[::-1], -1, *after[:most][::-1], *before[::-1]])
    found = []
    for q in range(lo, most + 1):
        ahead = min(forward[q], reach) if q < len(after) else 0
        back = min(backward[len(before) + 1 + most - q], reach)
        if ahead + back >= reach:
            found.append((q, -back, ahead))
    return found


def _suspects(codes: np.ndarray, at: np.ndarray, end: np.ndarray, lo: int) -> np.ndarray:
    """Boundaries (numbers into ``at``) where some period's words match for long enough, as far as DEEP words tell."""
    deep = min(DEEP, -(-needed(lo) // 2))
    found = [np.zeros(0, dtype=np.int64)]
    for q_from in range(lo, 2 * lo, PAIRS):
        periods = np.arange(q_from, min(2 * lo, q_from + PAIRS))
        step = max(1, PAIRS // len(periods))
        for first in range(0, len(at), step):
            b = at[first:first + step]
            far = b[:, None] + periods
            inside = far <= end[first:first + step, None]
            for side in (0, -1):  # words from the boundary on, words before it
                move = 1 if side == 0 else -1
                same = inside & (codes[np.minimum(far, len(codes) - 1) + side] == codes[b + side][:, None])
                which, column = np.nonzero(same)
                x, y = b[which] + side, far[which, column] + side
                for depth in range(1, deep):
                    alike = codes[x + depth * move] == codes[y + depth * move]
                    which, x, y = which[alike], x[alike], y[alike]
                found.append(np.unique(which) + first)
    return np.unique(np.concatenate(found))


def solve(codes: np.ndarray, start: np.ndarray, end: np.ndarray, lo: int, at: np.ndarray, owner: np.ndarray
          ) -> list[tuple[int, int, int, int]]:
    """(document, period, first match, end of matches) found by the tiles of one octave; places within ``codes``.

    ``codes`` holds a number per word, and before and after each document one that occurs only once.  ``start`` and ``end``
    tell where documents begin and end, ``at`` and ``owner`` the boundaries and their documents, in order.
    """
    reach = needed(lo)
    found: list[tuple[int, int, int, int]] = []
    open_: dict[tuple[int, int], int] = {}
    for k in _suspects(codes, at, end[owner], lo):
        b, d = int(at[k]), int(owner[k])
        before = codes[max(int(start[d]), b - reach):b].tolist()
        after = codes[b:min(int(end[d]), b + reach + 2 * lo - 1)].tolist()
        for q, first, last in solve_tile(before, after, lo):
            place = open_.get((d, q))
            if place is not None and b + first <= found[place][3]:  # stitched at once to the tile before
                found[place] = (d, q, found[place][2], b + last)
            else:
                open_[d, q] = len(found)
                found.append((d, q, b + first, b + last))
    return found


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self)
        return value


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # splits at ASCII white space only


def _boundaries(start: np.ndarray, end: np.ndarray, lo: int) -> tuple[np.ndarray, np.ndarray]:
    """All boundaries of an octave in documents that are long enough for it, and whose they are."""
    size = end - start
    long = np.flatnonzero(size >= max(LEAST, EXPONENT * lo))
    counts = -(-size[long] // needed(lo))
    owner = np.repeat(long, counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return start[owner] + number * needed(lo), owner


def stretches(documents: list[list[bytes]]) -> list[list[Stretch]]:
    """Stretches of matches of each document, by its tiles of all octaves."""
    numbers = _Numbers()
    size = np.array([len(words) for words in documents], dtype=np.int64)
    codes = np.full(int(size.sum()) + len(documents) + 1, -1, dtype=np.int64)
    start = 1 + np.cumsum(size + 1) - (size + 1)
    end = start + size
    for words, at in zip(documents, start.tolist(), strict=True):
        codes[at:at + len(words)] = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
    codes[0] = -2
    codes[end] = -3 - np.arange(len(documents))
    out: list[list[Stretch]] = [[] for _ in documents]
    for lo in octaves(int(size.max(initial=0))):
        at, owner = _boundaries(start, end, lo)
        for d, q, first, last in solve(codes, start, end, lo, at, owner):
            out[d].append((q, first - int(start[d]), last - int(start[d])))
    return out


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Documents (id, text, words) in lists of bounded size."""
    some, size = [], 0
    for batch in batches:
        for id_, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py()
            words = words_of(text)
            some.append((id_.as_py(), text, words))
            size += len(words)
            if size >= SLICE:
                yield some
                some, size = [], 0
    if some:
        yield some


STRETCHES = "array<struct<period:long,start:long,stop:long>>"
RUNS = "array<struct<start:long,length:long,period:long>>"
_STRETCHES = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _worker(kind: pa.DataType, in_place: int, wanted: bool):
    """Worker that gives the documents with stretches, or too long to tell (``wanted``), or all others, done."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = count(TaskContext.get().partitionId() << 40)
        for some in _slices(batches):
            here = [len(words) <= in_place for _, _, words in some]
            found = stretches([words if near else [] for (_, _, words), near in zip(some, here, strict=True)])
            rows = [(doc, near, got) for doc, near, got in zip(some, here, found, strict=True)
                    if wanted == (bool(got) or not near)]
            ids = pa.array([doc[0] for doc, _, _ in rows], type=kind)
            if wanted:
                yield pa.RecordBatch.from_arrays([
                    pa.array([next(uid) for _ in rows], type=pa.int64()), ids,
                    pa.array([doc[1] for doc, _, _ in rows], type=pa.string()),
                    pa.array([not near for _, near, _ in rows], type=pa.bool_()),
                    pa.array([[dict(zip(("period", "start", "stop"), s, strict=True)) for s in got] for _, _, got in rows],
                             type=_STRETCHES)], names=["uid", "id", "text", "long", "stretches"])
            else:
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([len(doc[2]) for doc, _, _ in rows], type=pa.int64()),
                    pa.array([[] for _ in rows], type=_RUNS),
                    pa.array([b" ".join(doc[2]).decode() for doc, _, _ in rows], type=pa.string())],
                    names=["id", "n_words", "runs", "collapsed"])

    return run


def _bundles(size: int):
    """Worker that cuts the tiles of long documents into bundles of so many words, with what they reach beyond."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                numbers, words = _Numbers(), words_of(text.as_py())
                codes = np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words))
                for lo in octaves(len(codes)):
                    reach = needed(lo)
                    step = max(1, size // reach) * reach
                    for at in range(0, len(codes), step):
                        low = max(0, at - reach)
                        part = codes[low:at + step + reach + 2 * lo]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([uid]), pa.array([lo], type=pa.int64()), pa.array([low], type=pa.int64()),
                            pa.array([at - low], type=pa.int64()),
                            pa.array([min(at + step, len(codes)) - low], type=pa.int64()), pa.array([part.tobytes()])],
                            names=["uid", "lo", "low", "first", "last", "codes"])

    return run


def _solve_bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            uid, lo, low, first, last = (batch.column(i)[row].as_py() for i in range(5))
            words = np.frombuffer(batch.column(5)[row].as_py(), dtype=np.int32)
            codes = np.concatenate([[-2], words, [-3]])
            at = np.arange(first, last, needed(lo)) + 1
            found = solve(codes, np.array([1]), np.array([1 + len(words)]), lo, at, np.zeros(len(at), dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([uid] * len(found), type=pa.int64()), pa.array([f[1] for f in found], type=pa.int64()),
                 *[pa.array([low + f[i] - 1 for f in found], type=pa.int64()) for i in (2, 3)]],
                names=["uid", "period", "start", "stop"])


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, texts = [], []
        for text, runs in zip(batch.column(1), batch.column(2), strict=True):
            words = words_of(text.as_py())
            depth = np.zeros(len(words) + 1, dtype=np.int64)
            for run in runs.as_py():
                depth[run["start"] + run["period"]] += 1
                depth[run["start"] + run["length"]] -= 1
            sizes.append(len(words))
            texts.append(b" ".join([words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, type=pa.int64()), batch.column(2),
                                          pa.array(texts, type=pa.string())], names=["id", "n_words", "runs", "collapsed"])


def stitched(pieces: DataFrame) -> DataFrame:
    """Runs (``uid``, ``runs``) of stretches of matches (``uid``, ``period``, ``start``, ``stop``), whole or in pieces."""
    along = W.partitionBy("uid", "period").orderBy("start", "stop")
    reached = F.max("stop").over(along.rowsBetween(W.unboundedPreceding, -1))
    begins = (F.coalesce(F.col("start") > reached, F.lit(True))).cast("int")
    islands = pieces.withColumn("begins", begins).withColumn("island", F.sum("begins").over(along))
    whole = islands.groupBy("uid", "period", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    length = F.col("stop") - F.col("start") + F.col("period")
    long = whole.withColumn("length", length).where(F.col("length") >= F.greatest(F.lit(LEAST), EXPONENT * F.col("period")))
    # A stretch that repeats q words also repeats 2 q of them; its period is the smallest.
    smallest = long.groupBy("uid", "start", "length").agg(F.min("period").alias("period"))
    return smallest.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))


def periodic_runs(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", in_place: int = IN_PLACE,
                  bundle: int = BUNDLE) -> DataFrame:
    """One row per row of ``df``: the id, n_words, runs (start, length, period; by start, then period), collapsed.

    Words are cut at ASCII white space.  ``collapsed`` joins by one space the words that no run holds after its first period.
    Null and empty texts have no words.  Ids may be null or repeated, every row is judged by its own text; other columns are not
    read; an empty table gives an empty result.
    """
    texts = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind, arrow = texts.schema["id"].dataType.simpleString(), _arrow(texts)
    done = texts.mapInArrow(_worker(arrow, in_place, False), f"id {kind}, n_words long, runs {RUNS}, collapsed string")
    open_ = durable(texts.mapInArrow(_worker(arrow, in_place, True),
                                     f"uid long, id {kind}, text string, long boolean, stretches {STRETCHES}"))
    pieces = open_.select("uid", F.explode("stretches").alias("s")).select("uid", "s.*")
    bundles = open_.where("long").select("uid", "text").mapInArrow(
        _bundles(bundle), "uid long, lo long, low long, first long, last long, codes binary")
    sent = bundles.repartition("uid", "lo", "first", "low").mapInArrow(
        _solve_bundles, "uid long, period long, start long, stop long")
    runs = stitched(pieces.union(sent))
    joined = open_.select("uid", "id", "text").join(runs, "uid", "left").select(
        "id", "text", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"))
    collapsed = joined.mapInArrow(_collapse, f"id {kind}, n_words long, runs {RUNS}, collapsed string")
    return done.union(collapsed).withColumnRenamed("id", id_column)


def _arrow(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["id"].dataType)
