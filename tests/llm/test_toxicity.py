import random

import numpy as np
import pytest

from codesieve.llm import toxicity


def brute_kernel(s, t):
    """Sum over index triples of both words, as the kernel is defined."""
    def features(word):
        out = {}
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + toxicity.SPAN)):
                    key = word[i] + word[j] + word[k]
                    out[key] = out.get(key, 0.0) + toxicity.DECAY ** (k - i + 1)
        return out
    a, b = features(s), features(t)
    dot = lambda x, y: sum(v * y.get(k, 0.0) for k, v in x.items())
    return dot(a, b) / np.sqrt(dot(a, a) * dot(b, b))


def test_kernel_against_its_definition():
    words = ["idiot", "idxiot", "banana", "abracadabra", "table", "xyz", "idioma", "a" * 12]
    got = toxicity.kernel(words, words)
    for i, s in enumerate(words):
        for j, t in enumerate(words):
            assert abs(got[i, j] - brute_kernel(s, t)) < 1e-9, (s, t)


def test_folded_machine_equals_its_landmark_form():
    words = ["idiot", "moron", "table", "chair", "window", "garden", "yellow", "morning"]
    signs = np.array([1.0] * 2 + [-1.0] * 6)
    machine = toxicity._train(words, signs, np.ones(len(words)), words)
    values = machine.values(words)
    assert (values[:2] > 0.5).all() and (values[2:] < -0.5).all()
    assert machine.values(["idxiot"])[0] > machine.values(["gardexn"])[0]


def test_units_and_letters():
    assert "i d i o t" in toxicity.units("You I D I O T there")
    assert toxicity.letters("m0r%on!!") == "moron" and toxicity.letters("12345") == ""


def test_few_words_mark_toxic_documents():
    random.seed(1)
    clean = [f"w{i}" for i in range(400)]
    documents = [{random.choice(["scum", "loser"]), *random.sample(clean, 20)} for _ in range(60)]
    good = {w: 0.0 for d in documents for w in d} | {w: 3.0 for w in clean}
    assert set(toxicity.marking_words(documents, good)) == {"scum", "loser"}


@pytest.fixture(scope="module")
def corpus():
    random.seed(8)
    syllables = ["ta", "ri", "mo", "len", "sha", "ke", "do", "un", "pel", "vi"]
    word = lambda: "".join(random.choice(syllables) for _ in range(random.randint(1, 4)))
    rows = []
    for i in range(240):
        words = [word() for _ in range(random.randint(5, 40))]
        if i % 3 == 0:
            for _ in range(random.randint(1, 3)):
                words.insert(random.randrange(len(words)), random.choice(["scumbag", "worthless", "idiot"]))
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    return rows


def test_learns_insults_and_tolerates_insertions(spark, docs, corpus):
    df = docs(*[(i, t) for i, t, _ in corpus])
    labels = spark.createDataFrame([(i, y, 9) for i, _, y in corpus if i < 160] + [(None, 1, 0), (1, None, 0)],
                                   "doc_id long, toxic int, kept int")
    machine = toxicity.fit(df, labels)
    more = docs((1000, "ta ri scXumbag mo"), (1001, "W-o-r-t-h-l-e-s-s ta"), (1002, "i d i o t ri"), (1003, None),
                (1004, ""), (1005, "ta " * 20_000), (1006, "ta " * 20_000 + "idiot"), (None, "1234"), (1000, "ta"))
    got = [(r.doc_id, r.score, r.worst) for r in toxicity.score(df.unionByName(more), machine).collect()]
    truth = {i: y for i, _, y in corpus}
    held = [(truth[i], s) for i, s, _ in got if i is not None and 160 <= i < 240]
    assert all((s >= 0.7) == bool(y) for y, s in held)
    by_id = {i: s for i, s, _ in got if i not in (1000, None)}
    assert by_id[1001] >= 0.7 and by_id[1002] >= 0.7 and by_id[1006] >= 0.7
    assert by_id[1003] == by_id[1004] < 0.5 and by_id[1005] < 0.7
    assert max(s for i, s, _ in got if i == 1000) >= 0.7 > min(s for i, s, _ in got if i == 1000)
    kept = toxicity.without_toxic(df, machine, 0.7)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s, _ in got if i is not None and i < 240 and s < 0.7}


def test_gaps_that_are_spaces_and_phrases(spark, docs, corpus):
    random.seed(5)
    rows = [(i, t, y) for i, t, y in corpus]
    for i in range(240, 400):  # dark and moon are in clean documents too, but not side by side
        words = random.choice(rows[1:240:3])[1].split()
        if i % 2:
            words[2:2] = ["dark", "moon"]
        else:
            words.insert(1, "moon")
            words.append("dark")
        rows.append((i, " ".join(words), i % 2))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    machine = toxicity.fit(docs(*[r[:2] for r in rows]), labels)
    texts = ["ta ri worth less mo", "ri worth\nless", "ta i - d - i - o - t ri", "ta scu mb ag ri", "ri dark moon ta"]
    got = {r.doc_id: r.score for r in toxicity.score(docs(*enumerate(texts), (9, "ta dark ri mo moon")), machine).collect()}
    assert [k for k in range(5) if got[k] < 0.7] == [] and got[9] < 0.7


def test_bounds_of_windows_hold_and_the_worst_window_is_found():
    random.seed(6)
    words = ["idiot", "moron", "table", "chair", "window", "garden", "yellow", "morning"]
    machine = toxicity._train(words, np.array([1.0] * 2 + [-1.0] * 6), np.ones(8), words)
    texts = [["".join(random.choice("idotmrn") for _ in range(random.randint(1, 9))) for _ in range(30)] for _ in range(20)]
    plain, owner = sum(texts, []), np.repeat(np.arange(20), 30)
    for size, first, bound in machine.window_bounds(plain, np.array([len(w) for w in plain]), owner):
        values = machine.values(["".join(plain[i:i + size]) for i in first])
        assert (values <= bound).all() and len(first) > 300
    got = toxicity._worst_units([" ".join(t) for t in texts], machine, toxicity._Bare())[0]
    for t, value in zip(texts, got, strict=True):
        joined = ["".join(t[i:i + n]) for n in range(1, 5) for i in range(31 - n)]
        assert abs(max(machine.values([w for w in joined if len(w) <= 32])) - value) < 1e-6


def test_one_class_no_labels_and_empty(spark, docs):
    df = docs((1, "a b"), (2, None))
    for rows, prior in (([(1, 0)], 0.0), ([(1, 1)], 1.0), ([], 0.0)):
        machine = toxicity.fit(df, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert [r.score for r in toxicity.score(df, machine).collect()] == [prior] * 2
    assert toxicity.score(df.limit(0), machine).collect() == []


def test_untrained_machine_keeps_all_rows(spark, docs):
    df = docs((1, "a b"), (2, None))
    for rows in ([(1, 1)], [(1, 0)], [(1, 1), (2, 1)], []):
        machine = toxicity.fit(df, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert {r.doc_id for r in toxicity.without_toxic(df, machine, 0.7).collect()} == {1, 2}


def test_subsequences_against_definition():
    """Each subsequence once, ascending, with the sum of its weights, normalised; fillers weigh nothing."""
    import numpy as np

    words = ["ab", "abc", "aaaaaaaaa", "abcabcabcabc", "x" * 32, "überüber"]
    numbers, weights = toxicity.subsequences(words)
    for word, row, have in zip(words, numbers, weights, strict=True):
        codes, want = toxicity._numbers(word), {}
        for first in range(len(word)):
            for i, j in toxicity._PATTERNS:
                if first + j < len(word):
                    key = int((codes[first] * 64 + codes[first + i]) * 64 + codes[first + j])
                    want[key] = want.get(key, 0.0) + toxicity.DECAY ** (j + 1)
        norm = np.sqrt(sum(v * v for v in want.values()))
        got = {int(n): v for n, v in zip(row, have, strict=True) if n}
        assert list(got) == sorted(want) and (have[row == 0] == 0).all()
        assert np.allclose([got[k] for k in sorted(want)], [want[k] / norm for k in sorted(want)], atol=1e-12)


def test_kernel_holds_few_words_at_a_time():
    import tracemalloc

    random.seed(5)
    words = ["".join(random.choice("abcdefgh") for _ in range(random.randint(1, 32))) for _ in range(3000)]
    tracemalloc.start()
    got = toxicity.kernel(words, words[:5])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    apart = toxicity.kernel(words[1000:1004] + [max(words, key=len)], words[:5])  # alike wherever a word lies
    assert np.array_equal(got[1000:1004], apart[:4])
