"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel of two words sums, over the three-letter subsequences they share, ``DECAY`` to the power of both spans
(spans of at most ``SPAN`` letters), and is normalised.  Insults with letters put in or left out thus stay near.  A
machine is trained on sentences of a bounded sample of labelled documents.  It begins with few words that mark the toxic
documents; then a sentence stands for its worst word, a toxic document for its worst sentence, a clean one for its
three worst (which makes them hard examples), and it is trained anew.  Words are mapped to the space that the kernel
with ``LANDMARKS`` landmark words spans.  Since a kernel value is a sum over
subsequences, the trained machine is folded into one weight per subsequence; a word's value is the same as with the
landmarks.  A text's score is the calibrated value of its worst unit: a word, a run of letters spelled out, or a window
of up to ``JOINED`` neighbouring words whose letters are joined, so that a gap may be a space or a line end.  Every
window is bounded from above (its norm is least if no subsequence repeats); those that may be worst are worked out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import durable, hand_back

DECAY, SPAN = 0.6, 8
LANDMARKS = 160
#: Labelled documents of either class that the machine is fitted on at most, and clean words kept for it.
SAMPLE_TOXIC, SAMPLE_CLEAN, HARD_WORDS = 2000, 4000, 3000
ROUNDS = 3
PENALTY = 20.0
LONGEST = 32
#: Words of a window; windows of more than LONGEST letters are not looked at.
JOINED = 4
CHUNK = 50_000
#: Documents of either class set apart for calibration; with fewer the whole sample is taken.
LEAST_CHECKED = 50
KEPT_WORDS = 100_000
CODES = 64
#: Words whose subsequences the driver holds at once.
AT_ONCE = 512

NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Signs that stand for letters inside a word.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
SIGN = re.compile(r"(?<=[^\W\d_])[013457@$](?=[^\W\d_])")
SPELLED = re.compile(r"(?<!\w)\w(?:\W{1,5}\w){3,}(?!\w)")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")

_PATTERNS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
_WEIGHTS = np.array([DECAY ** (j + 1) for _, j in _PATTERNS])
_PATTERN_BITS = len(_PATTERNS).bit_length()
#: Norm of so many letters if no subsequence repeats, and if all are the same.
_LEAST_NORM = np.sqrt([sum(max(0, n - j) * DECAY ** (2 * j + 2) for _, j in _PATTERNS) for n in range(LONGEST + 1)])
_MOST_NORM = np.array([sum(max(0, n - j) * DECAY ** (j + 1) for _, j in _PATTERNS) for n in range(LONGEST + 1)])


def letters(word: str) -> str:
    """Letters of a lower-cased word; signs between letters count as the letters they stand for."""
    if word.isalpha():
        return word
    return NOT_LETTERS.sub("", SIGN.sub(lambda m: SIGNS[m.group()], word))


def units(text: str) -> list[str]:
    """Words of a text (lower case, as written), and runs of letters spelled out singly."""
    text = text.lower()
    return text.split() + [m.group() for m in SPELLED.finditer(text)]


def _numbers(text: str) -> np.ndarray:
    """Letters as numbers; a-z keep apart from each other and from all other letters."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
    plain = (points >= 97) & (points <= 122)
    return np.where(plain, points - 96, 27 + points % 37)


def _codes(words: list[str]) -> np.ndarray:
    """Numbers of the letters of each word, 0 beyond the end."""
    lengths = np.array([len(w) for w in words])
    codes = _numbers("".join(words))
    out = np.zeros((len(words), int(lengths.max())), dtype=np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = codes
    return out


def subsequences(words: list[str], width: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Per word (row): numbers of its subsequences, each once, and their normalised weights; 0 fills up.

    Rows are as long as for words of ``width`` letters at least.
    """
    codes = _codes(words)
    codes = np.pad(codes, ((0, 0), (0, SPAN + max(0, width - codes.shape[1]))))
    width = codes.shape[1] - SPAN
    first = codes[:, :width]
    found = []
    for k, (i, j) in enumerate(_PATTERNS):
        last = codes[:, j:j + width]
        number = (first * CODES + codes[:, i:i + width]) * CODES + last
        found.append(np.where(last > 0, number << _PATTERN_BITS | k, 0))
    # A number and its pattern in one value: sorting values is much cheaper than sorting places and moving two arrays.
    both = np.sort(np.concatenate(found, axis=1), axis=1)
    numbers, values = both >> _PATTERN_BITS, _WEIGHTS[both & ((1 << _PATTERN_BITS) - 1)]
    values[numbers == 0] = 0.0
    new = np.ones(numbers.shape, dtype=bool)
    new[:, 1:] = numbers[:, 1:] != numbers[:, :-1]
    starts = np.flatnonzero(new.ravel())
    sums = np.zeros(numbers.size)
    sums[starts] = np.add.reduceat(values.ravel(), starts)
    sums = sums.reshape(numbers.shape)
    norms = np.sqrt((sums ** 2).sum(axis=1, keepdims=True))
    return np.where(new, numbers, 0), np.divide(sums, norms, out=np.zeros_like(sums), where=norms > 0)


def kernel(words: list[str], others: list[str]) -> np.ndarray:
    """Normalised kernel of each word with each other word; few words at a time, in rows of one length."""
    out = np.empty((len(words), len(others)))
    table = np.zeros(CODES ** 3)
    other_numbers, other_values = subsequences(others)
    width = max(map(len, words), default=0)
    for at in range(0, len(words), AT_ONCE):
        numbers, values = subsequences(words[at:at + AT_ONCE], width)
        for j in range(len(others)):
            table[other_numbers[j]] += other_values[j]
            out[at:at + AT_ONCE, j] = (table[numbers] * values).sum(axis=1)
            table[other_numbers[j]] = 0.0
    return out


@dataclass
class Machine:
    """Weight per subsequence, offset, and the line that calibrates values to scores."""

    table: np.ndarray | None
    offset: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    prior: float = 0.0

    def values(self, words: list[str]) -> np.ndarray:
        """Value of words given as letters; windows of a long one count each."""
        out = np.full(len(words), self.offset)
        pieces, owner = [], []
        for k, word in enumerate(words):
            for at in range(0, max(1, len(word) - LONGEST // 2), LONGEST // 2):
                piece = word[at:at + LONGEST]
                if len(piece) >= 3:
                    pieces.append(piece)
                    owner.append(k)
        order = sorted(range(len(pieces)), key=lambda k: len(pieces[k]))
        best = np.full(len(words), -np.inf)
        for at in range(0, len(order), 512):
            some = order[at:at + 512]
            numbers, weights = subsequences([pieces[k] for k in some])
            found = (self.table[numbers] * weights).sum(axis=1) + self.offset
            np.maximum.at(best, [owner[k] for k in some], found)
        return np.where(np.isfinite(best), best, out)

    def window_bounds(self, words: list[str], lengths: np.ndarray, owner: np.ndarray
                      ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per size: the first words of all windows inside one text, and what their values do not exceed."""
        ends = np.cumsum(lengths)
        n = int(ends[-1])
        codes = np.pad(_numbers("".join(words)), (0, SPAN))
        first = codes[:n] * CODES
        upto = np.zeros((SPAN, n), dtype=np.float32)  # of the subsequences from a letter on, by their last letter
        pairs = [(first + codes[i:i + n]) * CODES for i in range(1, SPAN - 1)]
        for j in range(2, SPAN):
            last = codes[j:j + n]
            found = self.table[pairs[0] + last]
            for i in range(2, j):
                found += self.table[pairs[i - 1] + last]
            found[last == 0] = 0
            np.multiply(found, np.float32(DECAY ** (j + 1)), out=found)
            np.add(upto[j - 1], found, out=upto[j])
        before = np.concatenate([[0.0], np.cumsum(upto[-1], dtype=np.float64)])
        for size in range(1, JOINED + 1):
            if len(words) < size:
                return
            start, end = (ends - lengths)[:len(words) - size + 1], ends[size - 1:]
            good = np.flatnonzero((owner[:len(start)] == owner[size - 1:]) & (end - start >= 3) & (end - start <= LONGEST))
            start, end = start[good], end[good]
            total = before[np.maximum(start, end - SPAN + 1)] - before[start]
            for k in range(3, SPAN):
                total += np.where(end - k >= start, upto[k - 1][np.maximum(end - k, 0)], 0)
            norm = np.where(total > 0, _LEAST_NORM[end - start], _MOST_NORM[end - start])
            yield size, good, self.offset + total / norm + 1e-4

    def score(self, value: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * value + self.shift, -500, 500)))


class _Bare(dict):
    """Letters of words as written, kept in a bounded memory."""

    def __missing__(self, word: str) -> str:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = letters(word)
        return value


def _train(words: list[str], labels: np.ndarray, weights: np.ndarray, landmarks: list[str]) -> Machine:
    """Squared-hinge machine in the landmarks' space, by Newton steps."""
    size, turn = np.linalg.eigh(kernel(landmarks, landmarks))
    good = size > 1e-6 * size.max()
    root = turn[:, good] / np.sqrt(size[good])
    x = np.hstack([kernel(words, landmarks) @ root, np.ones((len(words), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        inside = labels * (x @ w) < 1
        weighted = x[inside] * (PENALTY * weights[inside])[:, None]
        new = np.linalg.solve(ridge + weighted.T @ x[inside], weighted.T @ labels[inside])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    alpha = root @ w[:-1]
    table = np.zeros(CODES ** 3)
    numbers, values = subsequences(landmarks)
    np.add.at(table, numbers.ravel(), (values * alpha[:, None]).ravel())
    return Machine(table.astype(np.float32), float(w[-1]))


def _calibrate(machine: Machine, values: np.ndarray, toxic: np.ndarray) -> None:
    """Logistic line through values and labels, with smoothed targets."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(toxic, 0.5 / max(n1, 1), 0.5 / max(n0, 1)) * len(values)
    x = np.column_stack([values, np.ones(len(values))])
    line = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-3 * line
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        line = line - step
        if np.abs(step).max() < 1e-8:
            break
    machine.slope, machine.shift = float(line[0]), float(line[1])


def _sample(docs: DataFrame, labels: DataFrame, toxic: int, clean: int) -> DataFrame:
    """``text``, ``toxic``, ``check`` (kept for calibration) of so many labelled documents of either class at most."""
    labelled = labels.where("toxic in (0, 1) and id is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    classes = [labelled.where(F.col("toxic") == k).orderBy(F.xxhash64("id"), "id").limit(size)
               for k, size in ((0, clean), (1, toxic))]
    chosen = classes[0].union(classes[1])  # as many rows as the two limits allow
    return durable(docs.join(F.broadcast(chosen), "id").select(
        F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") == 1).alias("toxic"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0).alias("check")))


def _words(text: str) -> set[str]:
    """Words of a text as letters, and pairs of neighbours with a space."""
    single = [letters(w) for w in text.lower().split()]
    single = [w for w in single if w]
    pairs = {f"{a} {b}" for a, b in zip(single, single[1:]) if 3 <= len(a) + len(b) <= LONGEST}
    return pairs | {word for word in (letters(w)[:LONGEST] for w in units(text)) if len(word) >= 3}


def _word_counts(sample: DataFrame) -> DataFrame:
    """``word``, and in how many toxic (``bad``) and clean (``good``) documents it is."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(word, toxic) for text, toxic in zip(batch["text"], batch["toxic"], strict=True)
                    for word in _words(text)]
            yield pd.DataFrame(rows, columns=["word", "toxic"])
        hand_back()

    return sample.mapInPandas(run, "word string, toxic boolean").groupBy("word").agg(
        F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good"))


def _holding(sample: DataFrame, candidates: set[str]) -> list[set[str]]:
    """The candidates that each toxic document of the sample holds."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"words": [sorted(_words(text) & candidates) for text in batch["text"]]})

    rows = sample.where("toxic").select("text").mapInPandas(run, "words array<string>").collect()
    return [set(row.words) for row in rows]


def marking_words(documents: list[set[str]], good: dict[str, float]) -> dict[str, float]:
    """Few words that mark the toxic documents: a greedy cover, then words that many of them hold besides.

    ``good``: how many clean documents hold a word, to the scale of the toxic ones; each counts three times
    against it.  Words shared only by documents that are alike in everything are left out in the second pass.
    """
    holders: dict[str, set[int]] = {}
    for k, words in enumerate(documents):
        for word in words:
            holders.setdefault(word, set()).add(k)
    need, chosen = [1] * len(documents), {}
    for cover, least in ((1, max(4.0, 0.002 * len(documents))), (3, max(6.0, 0.01 * len(documents)))):
        need = [cover - sum(w in chosen for w in words) for words in documents]
        open_ = {k for k, n in enumerate(need) if n > 0}
        while True:
            gains = {w: len(held & open_) - 3 * good[w] for w, held in holders.items() if w not in chosen}
            word = max(gains, key=lambda w: (gains[w], w), default=None)
            if word is None or gains[word] < least:
                break
            held = holders[word] & open_
            if cover > 1 and _alike([documents[k] for k in sorted(held)[:12]]):
                del holders[word]
                continue
            chosen[word] = float(len(holders[word]))
            for k in held:
                need[k] -= 1
            open_ = {k for k in open_ if need[k] > 0}
    return chosen


def _alike(documents: list[set[str]]) -> bool:
    shares = [len(a & b) / len(a | b) for i, a in enumerate(documents) for b in documents[:i]]
    return bool(shares) and sum(shares) / len(shares) > 0.4


def _worst(sample: DataFrame, machine: Machine) -> pd.DataFrame:
    """Worst word of the worst sentence of each toxic document, of three of each clean one: bounded by the sample."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bare = _Bare()
        for batch in batches:
            rows = []
            for text, toxic, check in batch[["text", "toxic", "check"]].itertuples(index=False):
                # a document's own windows too: an insult may run over a line end
                parts = [text, *SENTENCE.split(text)] if toxic else SENTENCE.split(text)
                worst = sorted(((v, w) for v, w in zip(*_worst_units(parts, machine, bare), strict=True) if w),
                               reverse=True)
                rows += [(letters(w)[:LONGEST], value, toxic, check, i)
                         for i, (value, w) in enumerate(worst[:1 if toxic else 3])]
            yield pd.DataFrame(rows, columns=["word", "value", "toxic", "check", "place"])
        hand_back()

    return sample.mapInPandas(run, "word string, value double, toxic boolean, check boolean, place int").toPandas()


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        toxic_column: str = "toxic", sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN) -> Machine:
    """Machine fitted on up to so many labelled documents of either class (those with the smallest hashes).

    Other labels than 0 and 1 and labels without a document are not used; a document labelled both ways counts as
    toxic.  Without documents of both classes every text gets the share of toxic ones as its score.
    """
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    marks = labels.select(F.col(id_column).alias("id"), F.col(toxic_column).cast("int").alias("toxic"))
    sample = _sample(texts, marks, sample_toxic, sample_clean)
    sizes = {row[0]: row[1] for row in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Machine(None, prior=float(bool(sizes.get(True))))
    odds = F.log((F.col("bad") + 0.5) / (sizes[True] + 1)) - F.log((F.col("good") + 0.5) / (sizes[False] + 1))
    counts = durable(_word_counts(sample).withColumn("odds", odds))
    pair = F.col("word").contains(" ")
    single, pairs = counts.where(~pair), counts.where(pair)
    marking = "bad >= 3 and odds > 1.5"
    strongest = F.desc(F.col("bad") * F.col("odds"))
    marked = [row for kind in (single, pairs)
              for row in kind.where(marking).orderBy(strongest, "word").limit(1500).collect()]
    usual = single.where("good > 0 and odds < 0.5").orderBy(F.desc("good"), F.xxhash64("word")).limit(HARD_WORDS // 2)
    rare = single.where("good > 0 and bad = 0").orderBy(F.xxhash64("word")).limit(HARD_WORDS // 2)
    apart = pairs.where("good > 0 and bad = 0").orderBy(F.xxhash64("word")).limit(HARD_WORDS // 4)
    alone = {row.word for row in marked if " " not in row.word}
    # a pair is wanted only where its words are harmless one by one
    clean_share = {row.word: row.good * sizes[True] / sizes[False] for row in marked
                   if row.word in alone or not alone.intersection(row.word.split())}
    bad = marking_words(_holding(sample, set(clean_share)), clean_share)
    if not bad:
        bad = {row.word: 1.0 for row in single.where("bad > 0").orderBy(F.desc("odds"), "word").limit(50).collect()}
    bad = {word.replace(" ", ""): times for word, times in bad.items()}
    clean = [row.word.replace(" ", "") for row in usual.union(rare).union(apart).collect()]
    if not bad or not clean:
        return Machine(None, prior=sizes[True] / (sizes[True] + sizes[False]))
    hard: list[str] = []
    for _ in range(ROUNDS):
        good = [w for w in dict.fromkeys([*hard, *clean]) if w not in bad][:2 * HARD_WORDS]
        words = [*bad, *good]
        signs = np.array([1.0] * len(bad) + [-1.0] * len(good))
        weights = np.concatenate([np.full(len(bad), 0.5 / len(bad)), np.full(len(good), 0.5 / len(good))])
        top = sorted(bad, key=lambda w: (-bad[w], w))[:LANDMARKS // 2]
        machine = _train(words, signs, weights * len(words), [*top, *good[:LANDMARKS - len(top)]])
        worst = _worst(sample, machine)
        clean_rows = worst[~worst["toxic"]].sort_values(["value", "word"], ascending=False)
        hard = [w for w in clean_rows["word"] if len(w) >= 3]
        seen, known = worst.loc[worst["toxic"], "word"].value_counts(), set(hard)
        for word, times in seen[seen >= 2].items():  # a word that one document alone has may be there by chance
            if len(word) >= 3 and word not in known and word not in bad and len(bad) < HARD_WORDS:
                bad[word] = float(times)
    first = worst[worst["place"] == 0]
    check = first[first["check"]]
    if check["toxic"].sum() < LEAST_CHECKED or (~check["toxic"].astype(bool)).sum() < LEAST_CHECKED:
        check = first
    _calibrate(machine, check["value"].to_numpy(), check["toxic"].to_numpy(dtype=bool))
    return machine


def score(df: DataFrame, machine: Machine, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, score (0 to 1), worst (the word that made it, as written; null without words).

    Whole texts are read.  Null and empty texts have no words and get the score of a word that resembles nothing.
    Ids may be null or repeated; other columns are not read; an empty table gives an empty result.
    """
    rows = df.select(F.col(id_column).alias("id"),
                     F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bare = _Bare()
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                scores, worst = _scores(part["text"].tolist(), machine, bare)
                yield pd.DataFrame({"id": part["id"].to_numpy(), "score": scores, "worst": worst})
        bare.clear()
        hand_back()

    if machine.table is None:
        return df.select(F.col(id_column), F.lit(machine.prior).alias("score"), F.lit(None).cast("string").alias("worst"))
    return rows.mapInPandas(run, f"id {kind}, score double, worst string").withColumnRenamed("id", id_column)


def without_toxic(df: DataFrame, machine: Machine, least: float, text_column: str = "text") -> DataFrame:
    """Rows of ``df`` whose text scores below ``least``; columns as they are, no shuffle.

    A machine that could not be trained tells no text from another: all rows stay.
    """
    if machine.table is None:
        return df

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bare = _Bare()
        for batch in batches:
            yield pd.Series(np.concatenate([_scores(batch.iloc[at:at + 256].tolist(), machine, bare)[0]
                                            for at in range(0, len(batch), 256)] or [np.zeros(0)]))
        bare.clear()
        hand_back()

    return df.where(scored(F.coalesce(F.col(text_column).cast("string"), F.lit(""))) < least)


def _worst_units(texts: list[str], machine: Machine, bare: _Bare) -> tuple[list[float], list[str | None]]:
    """Value and worst unit of each text; without units the value of a word that resembles nothing, and None.

    Words and windows whose bounds are highest are worked out first; most others then lie below what their text has.
    """
    best, worst = np.full(len(texts), -np.inf), np.full(len(texts), None, dtype=object)
    written, sizes, spelled = [], np.zeros(len(texts), dtype=np.int64), []
    for k, text in enumerate(texts):
        text = text.lower()
        words = text.split()
        written += words
        sizes[k] = len(words)
        spelled += [(k, m.group()) for m in SPELLED.finditer(text)]

    def judge(owners: list[int], names: list[str], plain: list[str]) -> None:
        for k, name, value in zip(owners, names, machine.values(plain).tolist(), strict=True):
            if value > best[k]:
                best[k], worst[k] = value, name

    plain = list(map(bare.__getitem__, written))
    lengths = np.fromiter(map(len, plain), dtype=np.int64, count=len(plain))
    owner = np.repeat(np.arange(len(texts)), sizes)
    # A word of one or two letters, or none, resembles nothing; no text is below such a word that it has.
    short = np.flatnonzero(lengths < 3)
    for i in short[np.unique(owner[short], return_index=True)[1]].tolist():
        best[owner[i]], worst[owner[i]] = machine.offset, written[i]
    long = np.flatnonzero(lengths > LONGEST).tolist()
    judge([k for k, _ in spelled] + owner[long].tolist(), [w for _, w in spelled] + [written[i] for i in long],
          [letters(w) for _, w in spelled] + [plain[i] for i in long])
    some = np.flatnonzero(lengths)
    for at in range(0, len(some), CHUNK):
        part = some[at:at + CHUNK + JOINED - 1]
        words = [plain[i][:LONGEST + 1] for i in part.tolist()]
        _judge_windows(machine, words, np.minimum(lengths[part], LONGEST + 1), owner[part],
                       [written[i] for i in part.tolist()], best, judge)
    best[np.isneginf(best)] = machine.offset
    return best.tolist(), worst.tolist()


def _judge_windows(machine: Machine, words: list[str], lengths: np.ndarray, owner: np.ndarray, written: list[str],
                   best: np.ndarray, judge) -> None:
    """Works out the windows that may be worse than the worst of their text, those with the highest bounds first."""
    found = [(np.full(len(first), size), first, bound) for size, first, bound in machine.window_bounds(words, lengths, owner)]
    size, first, bound = (np.concatenate(column) for column in zip(*found, strict=True))
    whose = owner[first]
    open_ = np.flatnonzero(bound > best[whose])
    open_ = open_[np.lexsort((-bound[open_], whose[open_]))]
    at_once = 1
    while len(open_):
        heads = np.ones(len(open_), dtype=bool)  # the next few of each text
        heads[at_once:] = whose[open_[at_once:]] != whose[open_[:-at_once]]
        at_once *= 2
        now = [(int(first[i]), int(first[i] + size[i]), int(whose[i])) for i in open_[heads].tolist()]
        judge([k for _, _, k in now], [" ".join(written[a:b]) for a, b, _ in now], ["".join(words[a:b]) for a, b, _ in now])
        open_ = open_[~heads]
        open_ = open_[bound[open_] > best[whose[open_]]]


def _scores(texts: list[str], machine: Machine, bare: _Bare) -> tuple[np.ndarray, list[str | None]]:
    """Scores and worst units of texts."""
    values, worst = _worst_units(texts, machine, bare)
    return machine.score(np.array(values)), worst
