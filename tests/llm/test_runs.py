import random

import pytest

from codesieve.llm import runs


def brute(words):
    """Runs of a list of words by their definition, and the words kept."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)  # the smallest period is found first
    dropped = {i for (start, length), q in found.items() for i in range(start + q, start + length)}
    return sorted((s, k, q) for (s, k), q in found.items()), " ".join(w for i, w in enumerate(words) if i not in dropped)


def texts():
    rng = random.Random(5)
    out = ["", None, "a", " \t\n ", "a " * 5, "a " * 6, "a b " * 3, "a b " * 4, "a b c " * 3 + "a b", "x y " * 9, "a\x0bb\x0c" * 4]
    for _ in range(150):  # few letters: many small runs
        out.append(" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 60))))
    for _ in range(60):  # planted runs of all periods, some continued in a run of another period
        words = [rng.choice("abcdefghij") for _ in range(rng.randrange(5, 40))]
        for _ in range(rng.randrange(1, 4)):
            unit = [rng.choice("abcdefghij") for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 40, 130]))]
            words += (unit * 9)[:rng.randrange(len(unit), 9 * len(unit))]
            words += [rng.choice("abc") for _ in range(rng.randrange(0, 7))]
        out.append(rng.choice([" ", "  ", "\n"]).join(words))
    unit = [str(rng.randrange(10**6)) for _ in range(900)]
    out.append(" ".join(["head", *unit * 5, "tail"]))
    return out


@pytest.mark.parametrize("in_place, bundle", [(runs.IN_PLACE, runs.BUNDLE), (10, 16)])
def test_against_brute_force(docs, in_place, bundle):
    """The second case sends the tiles of nearly every document to other tasks, in small bundles."""
    rows = list(enumerate(texts())) + [(None, "a " * 8), (3, "b " * 9), (3, "b " * 9)]
    got = runs.periodic_runs(docs(*rows), in_place=in_place, bundle=bundle).collect()
    assert len(got) == len(rows)
    have = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str)
    want = []
    for i, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        found, kept = brute(words)
        want.append((i, len(words), found, kept))
    assert have == sorted(want, key=str)


def test_long_text_and_empty_table(docs):
    words = ["w"] * 50_000 + [f"v{i % 1000}" for i in range(150_000)] + [f"u{i}" for i in range(3000)]
    (row,) = runs.periodic_runs(docs((1, " ".join(words)))).collect()
    assert [tuple(r) for r in row.runs] == [(0, 50_000, 1), (50_000, 150_000, 1000)]
    assert row.collapsed == " ".join(["w", *[f"v{i}" for i in range(1000)], *words[200_000:]])
    assert runs.periodic_runs(docs((1, "a")).limit(0)).collect() == []


def test_slice_without_a_run_after_one_with_runs(spark):
    """One task hands on several slices of documents; the second holds nothing that goes on."""
    plain = [(i, " ".join(f"w{i}_{j}" for j in range(100_000))) for i in range(3)]
    rows = [(10, "a " * 8), *plain, (11, "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in runs.periodic_runs(df).collect()}
    assert got == {10: [(0, 8, 1)], 0: [], 1: [], 2: [], 11: []}


def test_z_function_and_tiles_against_definition():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(0, 30))]
        want = [0] * len(s)
        for i in range(1, len(s)):
            while i + want[i] < len(s) and s[want[i]] == s[i + want[i]]:
                want[i] += 1
        assert runs.z_function(s) == want


def test_query_against_its_contract(docs):
    """The texts that the query judges are those the contract describes."""
    from zlib import crc32

    from codesieve.llm.queries import planted_runs

    rng = random.Random(8)
    rows = [(i, " ".join(str(rng.randrange(10**6)) for _ in range(rng.randrange(0, 90)))) for i in range(400)]
    rows += [(1000 + i, t) for i, t in enumerate(["", None, " ", "x"] * 20)] + [(None, "a b c")]
    got = {r.doc_id: r.text for r in planted_runs(docs(*rows)).collect()}
    changed = 0
    for i, text in rows:
        words, h = (text or "").split(), crc32(str(i).encode())
        n, g = len(words), h // 10
        if i is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
            changed += words != (text or "").split()
        assert (got[i] or "").split() == words
    assert changed > 20
