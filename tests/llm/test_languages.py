import itertools
import random

import numpy as np

from codesieve.llm import languages

ENGLISH = "the house is near the river and they think that this weather will hold with other things we know"
GERMAN = "das haus steht nicht weit vom fluss und sie denken dass sich das wetter noch lange halten wird ich weiß"
RUSSIAN = "дом стоит недалеко от реки и они думают что погода еще долго будет держаться мы знаем"


def train(spark):
    random.seed(1)
    rows = []
    for i in range(90):
        name, text = (("en", ENGLISH), ("de", GERMAN), ("ru", RUSSIAN))[i % 3]
        rows.append((i, " ".join(random.sample(text.split(), 12)), name))
    rows += [(900, "zzz", None), (901, None, "en"), (902, "", "de")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_viterbi_against_all_paths():
    random.seed(2)
    for _ in range(200):
        scores = np.array([[random.uniform(-5, 5) for _ in range(3)] for _ in range(6)])
        penalty = random.uniform(0, 8)
        value = lambda p: sum(scores[i][k] for i, k in enumerate(p)) - penalty * sum(  # noqa: B023, E731
            a != b for a, b in itertools.pairwise(p))
        best = max(map(value, itertools.product(range(3), repeat=6)))
        assert abs(value(languages.viterbi(scores, penalty).tolist()) - best) < 1e-9


def test_whole_and_mixed_texts(spark, docs):
    profiles = languages.fit(train(spark))
    assert profiles.names == ["de", "en", "ru"]
    mixed = f"{ENGLISH} {ENGLISH}. {GERMAN}"
    rows = [(1, ENGLISH), (2, GERMAN.upper()), (3, RUSSIAN), (4, None), (5, ""), (6, "12 34 !?"), (7, mixed),
            (8, "你好"), (1, GERMAN), (None, f"{ENGLISH} " * 2000)]
    got = sorted(((r.doc_id, r.lang_pred, r.spans) for r in languages.identify(docs(*rows), profiles).collect()), key=str)
    assert [g[:2] for g in got if g[0] not in (8, None)] == [
        (1, "de"), (1, "en"), (2, "de"), (3, "ru"), (4, "und"), (5, "und"), (6, "und"), (7, "en")]
    assert [g[1] for g in got if g[0] is None] == ["en"]
    first, second = next(g[2] for g in got if g[0] == 7).split(",")
    assert first.startswith("en:0:") and second.startswith("de:") and abs(int(second.split(":")[1]) - 2 * len(ENGLISH)) < 20
    name, score, spans = languages.label(mixed, profiles)
    assert name == "en" and 0.5 < score < 0.9 and len(spans) == 2


def test_scripts_rule_languages_out(spark):
    profiles = languages.fit(train(spark))
    assert languages.label("щщщ", profiles)[0] == "ru"
    starts, _, scores = profiles.words(languages._points(["щщщ zzz"]))
    assert len(starts) == 2 and scores[0][0] == scores[0][1] == -1e9 and scores[1][2] == -1e9


def test_no_profiles_and_empty(spark, docs):
    empty = languages.fit(train(spark).limit(0))
    assert [(r.lang_pred, r.score) for r in languages.identify(docs((1, "a")), empty).collect()] == [("und", 0.0)]
    assert languages.identify(docs((1, "a")).limit(0), languages.fit(train(spark))).collect() == []
