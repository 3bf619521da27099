import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from codesieve.llm import phrases


def brute(rows, longest, least, most, percent):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            sizes[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i:i + size])] += 1
    out = []
    for lang, found in counts.items():
        chosen = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in chosen.items():
            score, _, left, right = min((10**6 * a * a // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]])
                                        for k in range(1, len(p)))
            longer = [f for q, f in chosen.items() if len(q) > len(p) and any(
                q[i:i + len(p)] == p for i in range(len(q)))]
            if not any(100 * f >= percent * a for f in longer):
                rows.append((score, a, " ".join(p), left, right))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i, p, a, left, right, sizes[lang], score)
                for i, (score, a, p, left, right) in enumerate(rows[:most], 1)]
    return sorted(out)


def texts(seed, count):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "The", "of", "É", "é", "x\x01", "x", "new", "york", "City", "\x0b", ".", ",", "\n", "\t", "  ", "!"]
    out = [("en", None), (None, ""), (None, "a a a a a a a a a a a a a"), ("fr", "...!?"), ("de", "lone words here")]
    for _ in range(count):
        words = []
        for _ in range(rng.randrange(0, 60)):
            words += ["New", "York", "city"] if rng.random() < 0.1 else [rng.choice(vocabulary)]
        out.append((rng.choice(["en", "fr", None]), " ".join(words)))
    return out


@pytest.mark.parametrize("longest, least, most, budget", [(3, 10, 2000, phrases.BUDGET), (3, 3, 40, 50), (4, 2, 10**6, 20), (2, 5, 9, 1)])
def test_against_brute_force(docs, longest, least, most, budget):
    """Small budgets make prefixes of one, two and three words longer."""
    rows = texts(longest, 250)
    df = docs(*[(i, text, lang) for i, (lang, text) in enumerate(rows)])
    got = phrases.collocations(df, longest, least, most, budget=budget)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, longest, least, most, 50)


def test_empty_table_and_long_texts(docs):
    assert phrases.collocations(docs((1, "a b")).limit(0)).collect() == []
    row, = phrases.collocations(docs((1, "p q. " * 300_000, "en"))).collect()
    assert tuple(row) == ("en", 1, "p q", 300_000, 300_000, 300_000, 600_000, 10**6)


def test_held_words_are_passed_on_in_parts(docs, monkeypatch):
    rows = texts(9, 120)
    held = {"HELD_WORDS": 50, "JOINED_BYTES": 40}
    for name, value in held.items():
        monkeypatch.setattr(phrases, name, value)
    df = docs(*[(i, text, lang) for i, (lang, text) in enumerate(rows)])
    got = phrases.collocations(df, 3, 4, budget=30).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3, 4, 2000, 50)


def test_combined_with_many_values():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 2**21, (5, 400)).astype(np.int32)
    rows = np.concatenate([rows, rows[:, :100]], axis=1)
    found, counts = phrases.combined(rows)
    want = Counter(map(tuple, rows.T.tolist()))
    assert [tuple(c) for c in found.T.tolist()] == sorted(want) and counts.tolist() == [want[k] for k in sorted(want)]
