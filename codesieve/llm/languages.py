"""Languages of whole texts and of the spans of mixed ones: script ranges, word scores, Viterbi.

A word's script leaves only the languages that were learned with letters of that script.  Its score in each of them
is the sum of its letter triples' log-probabilities.  Viterbi over the words, with a penalty for each change of
language, labels the spans.  A text in which no run of words favours another language by more than half the penalty
needs no search: the constant path is then the best one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import durable

# First code points of script ranges (fixed values): each range ends where the next begins; 0 is no script.
RANGES = [
    (0x0000, 0), (0x0041, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6),
    (0x0780, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 0), (0x0E00, 9), (0x0E80, 0), (0x10A0, 10), (0x1100, 11),
    (0x1200, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 12), (0x3100, 0), (0x3400, 13), (0xA000, 0),
    (0xAC00, 11), (0xD7B0, 0), (0xF900, 13), (0xFB00, 0), (0x20000, 13), (0x30000, 0),
]
SCRIPTS = 14
FIRSTS = np.array([first for first, _ in RANGES])
NAMES = np.array([script for _, script in RANGES], dtype=np.int8)

BINS = 1 << 16
#: Labelled documents of each language that the triples are counted in, in the mean.
SAMPLE_DOCUMENTS = 2000
PENALTY = 12.0
#: Least log-probability difference of a triple counts no more than this.
FLOOR = 1e-7
STEP = 400_000
UNKNOWN = "und"


def _letter_table() -> np.ndarray:
    """Per code point whether it is a letter."""
    return np.array([chr(point).isalpha() for point in range(0x110000)])


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    return _LETTERS[0]


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def triples(points: np.ndarray, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per letter its triple's bin (the letter with both neighbours, all else as a gap); word starts and ends."""
    held = np.where(is_letter, points, 0).astype(np.uint64)
    before, after = np.zeros_like(held), np.zeros_like(held)
    before[1:], after[:-1] = held[:-1], held[1:]
    mixed = (before * np.uint64(0x9E3779B1) + held * np.uint64(0x85EBCA77C2B2AE63) + after * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bins = (mixed >> np.uint64(48)).astype(np.int64)
    edges = np.diff(np.concatenate([[False], is_letter, [False]]).astype(np.int8))
    return bins, np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def scripts_of(points: np.ndarray) -> np.ndarray:
    return NAMES[np.searchsorted(FIRSTS, points, side="right") - 1]


@dataclass
class Profiles:
    """Languages, log-probabilities of triples (bins x languages) and the scripts each language was seen in."""

    names: list[str]
    table: np.ndarray
    scripts: np.ndarray

    def words(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words, and their scores: ruled-out languages get the lowest."""
        is_letter = letters()[points]
        bins, starts, ends = triples(points, is_letter)
        if not len(starts):
            return starts, ends, np.zeros((0, len(self.names)))
        at = np.flatnonzero(is_letter)
        first = np.searchsorted(at, starts)
        scores = np.add.reduceat(self.table[bins[at]], first, axis=0).astype(np.float64)
        allowed = self.scripts[scripts_of(points[starts])]
        none = ~allowed.any(axis=1)
        allowed[none] = True
        scores[~allowed] = -1e9
        return starts, ends, scores


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Best language per word, one penalty for each change; ties to the earlier language."""
    total = scores.sum(axis=0)
    best = int(total.argmax())
    gain = np.cumsum(scores - scores[:, best:best + 1], axis=0)
    lowest = np.minimum.accumulate(np.vstack([np.zeros((1, scores.shape[1])), gain[:-1]]), axis=0)
    if (gain - lowest).max() <= penalty / 2:  # half: a path may have one change less than it has spans
        return np.full(len(scores), best)
    rows, (count, width) = scores.tolist(), scores.shape
    value, back = rows[0], []
    for row in rows[1:]:
        top = max(value)
        leader = value.index(top)
        change = top - penalty
        back.append([k if value[k] >= change else leader for k in range(width)])
        value = [(value[k] if value[k] >= change else change) + row[k] for k in range(width)]
    state = value.index(max(value))
    path = [state]
    for choice in reversed(back):
        state = choice[state]
        path.append(state)
    return np.array(path[::-1])


def label(text: str, profiles: Profiles, penalty: float = PENALTY) -> tuple[str, float, list[tuple[str, int, int]]]:
    """Language of most letters, its share of them by how clearly words favour it, and spans (language, start, end)."""
    points = _points([text])
    starts, ends, scores = profiles.words(points)
    return _labelled(starts, ends, scores, profiles, penalty)


def _labelled(starts, ends, scores, profiles, penalty):
    if not len(starts):
        return UNKNOWN, 0.0, []
    path = viterbi(scores, penalty)
    weights = np.bincount(path, weights=ends - starts, minlength=len(profiles.names))
    best = int(weights.argmax())
    share = weights[best] / weights.sum()
    total = scores[path == best].sum(axis=0)
    others = np.delete(total, best)
    margin = (total[best] - others.max()) if len(others) else np.inf
    score = float(share * (1 / (1 + np.exp(-np.clip(margin, 0, 50)))))
    turns = np.flatnonzero(np.diff(path)) + 1
    firsts, lasts = np.concatenate([[0], turns]), np.concatenate([turns, [len(path)]]) - 1
    return profiles.names[best], score, [(profiles.names[path[a]], int(starts[a]), int(ends[b]))
                                         for a, b in zip(firsts, lasts, strict=True)]


def _counts(names: list[str]):
    """Worker: triples and scripts of labelled texts, summed in the task: a table of bounded size."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((len(names), BINS + SCRIPTS), dtype=np.int64)
        for batch in batches:
            for language, text in zip(batch["language"], batch["text"], strict=True):
                for at in range(0, len(text), STEP):
                    points = _points([text[at:at + STEP].lower()])
                    is_letter = letters()[points]
                    bins, _, _ = triples(points, is_letter)
                    row = table[names.index(language)]
                    row[:BINS] += np.bincount(bins[is_letter], minlength=BINS)
                    row[BINS:] += np.bincount(scripts_of(points[is_letter]), minlength=SCRIPTS)
        language, place = np.nonzero(table)
        yield pd.DataFrame({"language": language, "place": place, "n": table[language, place]})

    return run


def fit(docs: DataFrame, text_column: str = "text", language_column: str = "lang", id_column: str = "doc_id",
        sample_documents: int = SAMPLE_DOCUMENTS) -> Profiles:
    """Profiles of the languages of ``docs``, from about ``sample_documents`` documents of each: those whose hash is
    small enough (all, where a language has fewer).  Rows without a language or text teach nothing.
    """
    known = docs.select(F.col(id_column).alias("id"), F.col(language_column).cast("string").alias("language"),
                        F.col(text_column).cast("string").alias("text")).where("language is not null and text <> ''")
    sizes = {row[0]: row[1] for row in known.groupBy("language").count().collect()}
    names = sorted(sizes)
    if not names:
        return Profiles([], np.zeros((BINS, 0), dtype=np.float32), np.zeros((SCRIPTS, 0), dtype=bool))
    share = F.create_map(*[x for name in names for x in (F.lit(name), F.lit(sample_documents / sizes[name]))])
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share[F.col("language")] * 1_000_000)
    counted = durable(sample.select("language", "text").mapInPandas(_counts(names), "language int, place int, n long")
                      .groupBy("language", "place").agg(F.sum("n").alias("n")))
    table = np.zeros((BINS + SCRIPTS, len(names)))
    found = counted.toPandas()  # at most languages x (BINS + SCRIPTS) rows
    table[found["place"], found["language"]] = found["n"]
    grams, scripts = table[:BINS], table[BINS:]
    odds = np.log((grams + 0.1) / (grams.sum(axis=0) + 0.1 * BINS) + FLOOR).astype(np.float32)
    return Profiles(names, odds, scripts > 0.001 * np.maximum(scripts.sum(axis=0), 1))


def identify(df: DataFrame, profiles: Profiles, id_column: str = "doc_id", text_column: str = "text",
             penalty: float = PENALTY) -> DataFrame:
    """One row per row of ``df``: the id, lang_pred, score, spans (language:start:end in code points of the lower-cased text, by commas).

    ``und`` and 0 for null texts, texts without a letter, and without profiles.  Whole texts are read; a very long
    one word by word as all others.  Ids may be null or repeated; other columns are not read; an empty table gives
    an empty result.
    """
    rows = df.select(F.col(id_column).alias("id"),
                     F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _parts(batch):
                yield _identified(part, profiles, penalty)

    if not profiles.names:
        return df.select(F.col(id_column), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                         F.lit("").alias("spans"))
    return rows.mapInPandas(run, f"id {kind}, lang_pred string, score double, spans string").withColumnRenamed(
        "id", id_column)


def _parts(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows in parts of about ``STEP`` characters."""
    sizes = batch["text"].str.len().to_numpy().cumsum() // STEP if len(batch) else []
    for _, part in batch.groupby(sizes, sort=False):
        yield part


def _identified(part: pd.DataFrame, profiles: Profiles, penalty: float) -> pd.DataFrame:
    """All texts of a part scored in one pass; words never reach over a text's end."""
    texts = [text.lower() + "\n" for text in part["text"]]
    lengths = np.array([len(text) for text in texts])
    firsts = np.cumsum(lengths) - lengths
    starts, ends, scores = profiles.words(_points(texts))
    borders = np.searchsorted(starts, np.append(firsts, lengths.sum()))
    rows = []
    for first, a, b in zip(firsts, borders[:-1], borders[1:], strict=True):
        name, score, spans = _labelled(starts[a:b] - first, ends[a:b] - first, scores[a:b], profiles, penalty)
        rows.append((name, score, ",".join(f"{n}:{s}:{e}" for n, s, e in spans)))
    out = pd.DataFrame(rows, columns=["lang_pred", "score", "spans"])
    out.insert(0, "id", part["id"].to_numpy())
    return out
