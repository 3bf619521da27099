"""Exact duplicates of whole texts by two passes over a Bloom filter; DataFrame functions only.

Each text sets ``CELLS`` cells of one 64-bit word of a Bloom filter.  Pass one counts the texts of each word and set of cells,
combined before they are shuffled, and keeps in the filter only cells that some set of them had twice: equal texts set equal
cells.  Pass two probes every text: only if all its cells are in the filter can the text be repeated.  Only such rows are
shuffled by their digest; all others pass straight through.

The plan is the same at every size.  The filter has at most ``MOST_WORDS`` words and is broadcast (one row of 16 bytes a word);
since only repeated texts fill it, it tells single texts apart up to some 10^8 repeated ones.  Beyond, it lets more and more
single rows through to the shuffle; results do not change.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import durable, power_of_two
from codesieve.operators.partitioning import join_hot

#: Pattern of the white space that is folded to one space: fixed by the contract.
BLANKS = r"[\x20\x09-\x0D]+"
CELLS = 3
#: Words of a filter at most: 32 MB with their numbers.
MOST_WORDS = 1 << 21


def normalised(text: Column) -> Column:
    """Text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def _word(digest: Column, words: int) -> Column:
    return F.xxhash64(digest).bitwiseAND(F.lit(words - 1).cast("long"))


def _cells(digest: Column) -> list[Column]:
    hashed = F.xxhash64(digest)
    return [F.shiftrightunsigned(hashed, 36 + 6 * i).bitwiseAND(F.lit(63).cast("long")) for i in range(CELLS)]


def _bit(cell: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), cell.cast("int"))


def _mask(digest: Column) -> Column:
    return reduce(lambda x, y: x.bitwiseOR(y), [_bit(cell) for cell in _cells(digest)])


def repeated_cells(digests: DataFrame, words: int, digest: str = "_digest") -> DataFrame:
    """Pass one: ``_word``, ``_twice`` (the cells that two or more rows set together)."""
    masks = digests.select(_word(F.col(digest), words).alias("_word"), _mask(F.col(digest)).alias("_mask"))
    twice = masks.groupBy("_word", "_mask").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return twice.groupBy("_word").agg(F.bit_or("_mask").alias("_twice"))


def flag_repeated(rows: DataFrame, cells: DataFrame, words: int, digest: str = "_digest") -> DataFrame:
    """Pass two: ``rows`` with ``_maybe``, false only where the digest surely occurs once."""
    mask = _mask(F.col(digest))
    return (rows.withColumn("_word", _word(F.col(digest), words)).join(F.broadcast(cells), "_word", "left")
            .withColumn("_maybe", F.coalesce(F.col("_twice").bitwiseAND(mask) == mask, F.lit(False)))
            .drop("_word", "_twice"))


def filter_words(rows: int) -> int:
    """Words of a filter for so many rows: 16 bits a row, up to ``MOST_WORDS``."""
    return min(power_of_two(max(rows, 256) / 4), MOST_WORDS)


def find_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are so after ``normalised``.  Of equal texts the smallest id stays.  Null and empty
    texts are equal.  Rows without an id lose against rows with one; if no row of a group has an id, keep_id is
    null and all are kept.  A row that occurs twice, id and text, counts twice in group_size and is marked alike.
    An empty table gives an empty result.  Other columns are not read.
    """
    digests = durable(df.select(F.col(id_column).alias("_id"),
                                F.unhex(F.sha2(normalised(F.col(text_column)), 256)).alias("_digest")))
    words = filter_words(digests.count())
    flagged = flag_repeated(digests, repeated_cells(digests, words), words)
    single = flagged.where(~F.col("_maybe")).select(
        "_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "_digest")
    maybe = flagged.where("_maybe").select("_id", "_digest")
    groups = maybe.groupBy("_digest").agg(F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    grouped = join_hot(maybe, groups, "_digest", spread_by=F.xxhash64("_id")).select(*single.columns)
    return single.union(grouped).select(
        F.col("_id").alias(id_column), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"))


def drop_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``df`` with one row of each group of equal texts: that with the smallest id (a null id loses).

    Columns are returned as they are, whatever their names.  Rows that cannot be repeated pass without a shuffle.
    Of rows equal in id and text the one with the smallest hash of all columns stays.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(id_column).alias("_id"),
                     F.unhex(F.sha2(normalised(F.col(text_column)), 256)).alias("_digest"))
    digests = durable(rows.select("_digest"))
    words = filter_words(digests.count())
    flagged = flag_repeated(rows, repeated_cells(digests, words), words)
    first = F.struct(F.col("_id").isNull(), F.col("_id"), F.xxhash64("_row"))
    winners = flagged.where("_maybe").groupBy("_digest").agg(F.min_by("_row", first).alias("_row"))
    return flagged.where(~F.col("_maybe")).select("_row").union(winners.select("_row")).select("_row.*")
