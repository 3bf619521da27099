"""Secrets in whole texts: fixed patterns, and strings whose characters are too evenly mixed to be words.

Candidate strings are runs of the characters of keys.  A window slides over each; the Shannon entropy of the window
is kept up by adding the entering and taking out the leaving character's share of n log n.  The widest-spread class
of characters that a candidate needs (digits, hex, letters and digits, base64) sets window and threshold.
Candidates on the allow list are not reported: placeholders, UUIDs, paths of words (judged by the case and length of
their parts), and all that a fixed pattern already covers.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Patterns and shortest lengths fixed by the contract, in the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the same matches as [0-9a-f]+ of 16 characters or more, which are whole runs
ASSIGN_LENGTH, ACCESS_LENGTH = 12, 18
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGITS = re.compile(r"[0-9]+")
HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
ALNUM = re.compile(r"[A-Za-z0-9]+")


@dataclass(frozen=True)
class EntropyRule:
    """Bits of entropy that some window of so many characters must reach."""

    window: int
    bits: float


RULES = {"hex": EntropyRule(24, 3.1), "alnum": EntropyRule(24, 3.9), "base64": EntropyRule(24, 4.0)}
ALLOWED = (
    re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE),
    re.compile(r".*(example|sample|placeholder|changeme|dummy|xxxx|your[_-]?(key|token|secret)).*", re.IGNORECASE),
    re.compile(r"(.)\1*"),
)
#: Letters and separators, to be read in one way only: linear however long a run of separators is.
PATH = re.compile(r"[A-Za-z]+(?:[/_-]+[A-Za-z]+)*[/_-]*")
PLAIN = re.compile(r"[A-Z]+|[A-Z]?[a-z]+")
#: Words of a part in mixed case; an abbreviation in capitals may stand before a word.  Random letters give 2.7 a word.
CASED = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
LONGEST_WORD, MEAN_MIXED = 20, 4.0


def highest_entropy(text: str, window: int) -> float:
    """Largest Shannon entropy (bits a character) of any window of the text; of the whole text if it is shorter."""
    size = min(window, len(text))
    if not size:
        return 0.0
    share = [0.0] + [n * math.log2(n) for n in range(1, size + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    lowest = math.inf
    for i, entering in enumerate(text):
        if i >= size:
            leaving = text[i - size]
            n = counts[leaving] - 1
            counts[leaving] = n
            total += share[n] - share[n + 1]
        n = counts.get(entering, 0) + 1
        counts[entering] = n
        total += share[n] - share[n - 1]
        if i >= size - 1 and total < lowest:
            lowest = total
    return math.log2(size) - lowest / size


def character_class(text: str) -> str | None:
    """Narrowest class with a rule that holds all characters; None for digits alone."""
    if DIGITS.fullmatch(text):
        return None
    if HEX_ONLY.fullmatch(text):
        return "hex"
    return "alnum" if ALNUM.fullmatch(text) else "base64"


def of_words(text: str) -> bool:
    """Whether a candidate is letters and separators whose parts have the case and length of words."""
    if not PATH.fullmatch(text):
        return False
    parts = re.findall(r"[A-Za-z]+", text)
    mixed = [word for part in parts if not PLAIN.fullmatch(part) for word in CASED.findall(part)]
    plain = [part for part in parts if PLAIN.fullmatch(part)]
    return max(map(len, plain + mixed)) <= LONGEST_WORD and sum(map(len, mixed)) >= MEAN_MIXED * len(mixed)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of the fixed patterns, in code points."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_LENGTH]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2])))


def entropy_spans(text: str, covered: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans of candidates that reach their class's entropy, are not allowed and touch no covered span."""
    spans, at = [], 0
    ends = sorted((start, end) for start, end, _ in covered)
    reach = 0
    for match in CANDIDATE.finditer(text):
        start, end = match.span()
        while at < len(ends) and ends[at][0] < end:
            reach = max(reach, ends[at][1])
            at += 1
        if reach > start:
            continue
        found = match.group()
        kind = character_class(found)
        if kind is None or of_words(found) or any(allowed.fullmatch(found) for allowed in ALLOWED):
            continue
        if highest_entropy(found, RULES[kind].window) >= RULES[kind].bits:
            spans.append((start, end, "entropy"))
    return spans


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, n_assign, n_access, n_hex, n_entropy, base_spans, spans.

    Spans are written kind:start:end (code points, end exclusive), by start and then in the order of ``KINDS``,
    joined by commas; none give empty text, as do null and empty texts.  Whole texts are read.  Ids may be null or
    repeated; other columns are not read; an empty table gives an empty result.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                base = base_spans(text)
                more = entropy_spans(text, base)
                counts = [sum(kind == k for *_, kind in base) for k in KINDS[:3]]
                every = sorted(base + more, key=lambda span: (span[0], KINDS.index(span[2]))) if more else base
                rows.append((*counts, len(more), _joined(base), _joined(every)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_entropy", "base_spans", "spans"])
            out.insert(0, "id", batch["id"].to_numpy())
            yield out

    rows = df.select(F.col(id_column).alias("id"),
                     F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInPandas(run, f"id {kind}, n_assign long, n_access long, n_hex long, n_entropy long, "
                                  "base_spans string, spans string")
    return found.withColumnRenamed("id", id_column)
