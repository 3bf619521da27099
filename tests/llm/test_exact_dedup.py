import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from codesieve.llm import exact_dedup


def sha(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def test_against_brute_force(docs):
    texts = ["a b", "a  b", "a\tb", "a\x0bb", "a b", "", None, " ", "\n\n", "é" * 50_000, "é" * 50_000, "x"]
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts)] + [(200 + i, f"only {i}") for i in range(300)]
    got = {r.doc_id: r for r in exact_dedup.find_duplicates(docs(*rows)).collect()}
    groups = defaultdict(list)
    for i, t in rows:
        groups[sha(t)].append(i)
    assert len(got) == len(rows)
    for i, t in rows:
        group = groups[sha(t)]
        assert tuple(got[i]) == (i, min(group), len(group), i == min(group), sha(t))


def test_null_ids_and_repeated_rows(docs):
    rows = exact_dedup.find_duplicates(docs((None, "t"), (4, "t"), (4, "t"), (None, "u"), (None, "u"))).collect()
    by_text = defaultdict(list)
    for r in rows:
        by_text[r.text_sha256].append((r.doc_id, r.keep_id, r.group_size, r.kept))
    assert sorted(by_text[sha("t")], key=str) == [(4, 4, 3, True), (4, 4, 3, True), (None, 4, 3, False)]
    assert by_text[sha("u")] == [(None, None, 2, True)] * 2


def test_empty(docs):
    assert exact_dedup.find_duplicates(docs((1, "a")).limit(0)).collect() == []
    assert exact_dedup.drop_duplicates(docs((1, "a")).limit(0)).collect() == []


def test_dropping_keeps_columns_and_one_row(docs):
    df = docs((3, "a b"), (1, "a  b"), (1, "a  b"), (7, None), (8, ""), (9, "z"), (None, "z"), (None, "q"), (None, "q"))
    kept = exact_dedup.drop_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, "a  b"), (7, None), (9, "z"), (None, "q")], key=str)


def test_filter_never_misses_a_repeated_digest(spark):
    rows = spark.range(20_000).select(F.md5((F.col("id") % 15_000).cast("string")).cast("binary").alias("_digest"))
    words = exact_dedup.filter_words(20_000)
    flagged = exact_dedup.flag_repeated(rows, exact_dedup.repeated_cells(rows, words), words)
    counts = flagged.groupBy("_digest").agg(F.count("*").alias("n"), F.bool_and("_maybe").alias("m"),
                                           F.bool_or("_maybe").alias("o"))
    assert counts.where("n > 1 and not m").count() == 0
    assert counts.where("n = 1 and o").count() < 1500  # the filter lets few single rows through


def test_one_plan_at_every_size(docs, monkeypatch):
    """A filter too small for its rows lets more of them through, and loses none; texts are probed without a shuffle."""
    rows = [(i, f"t{i % 700}" if i % 3 else f"u{i}") for i in range(2100)]
    want = {(r.doc_id, r.keep_id) for r in exact_dedup.find_duplicates(docs(*rows)).collect()}
    monkeypatch.setattr(exact_dedup, "MOST_WORDS", 4)
    assert {(r.doc_id, r.keep_id) for r in exact_dedup.find_duplicates(docs(*rows)).collect()} == want
    kept = exact_dedup.drop_duplicates(docs(*rows))
    assert {r.doc_id for r in kept.collect()} == {keep for _, keep in want}
    assert "Cartesian" not in kept._jdf.queryExecution().toString() and exact_dedup.filter_words(10**12) == 4
