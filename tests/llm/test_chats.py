import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from codesieve.llm import chats

ODD = [r"\### Assistant: </turn> ok", "#" * 7, "</turn</turn>>", "\\0;\\1;", "", None, "a\nb:\n", "é" * 3000, "###</turn>\\", "  "]
TREE = "tree_id string, message_id long, parent_id long, role string, text string, score double, turns string, key string"


def read(found, *keys):
    formatted = F.col("formatted")
    return found.select(*keys, "n_turns", "score", "formatted", "loss_spans", chats.turns_of(formatted).alias("back"),
                        chats.learned_texts(formatted, F.col("loss_spans")).alias("learned")).collect()


def plain(text):
    return re.sub(r"\\([0-2]);", lambda m: ["\\", "###", "</turn>"][int(m[1])], text)


def test_turns_are_read_back(spark):
    rng = random.Random(3)
    want, rows = defaultdict(list), []
    for conv in range(40):
        for turn in range(rng.choice([1, 2, 5, 9, 700 if conv == 7 else 3])):
            said = (rng.choice(["user", "assistant", "sys:\n", None, "###"]), rng.choice(ODD))
            want[conv].append(tuple(x or "" for x in said))
            rows.append((conv, 3 * turn - 4, *said, "clash"))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in read(chats.format_turns(df.repartition(5)), "conv_id")}
    assert set(got) == set(want)
    for conv, turns in want.items():
        row = got[conv]
        assert [tuple(t) for t in row.back] == turns and row.n_turns == len(turns)
        assert row.learned == [t for role, t in turns if role == "assistant"]
        for span, text in zip(row.loss_spans, row.learned, strict=True):
            assert "</turn>" not in row.formatted[span.start:span.end]
            assert row.formatted[span.end:].startswith(chats.END)
            assert plain(row.formatted[span.start:span.end]) == text
        assert row.formatted.count(chats.CLOSING) == row.formatted.count(chats.OPENING) == len(turns)


def test_repeated_rows_null_turns_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(1, 1, "assistant", "x"), (1, 1, "assistant", "x"), (1, None, "user", "first"),
                                (None, 0, "user", "no id"), (1, 2, "assistant", "é")], schema)
    got = {r.conv_id: r for r in read(chats.format_turns(df), "conv_id")}
    assert [tuple(t) for t in got[1].back] == [("user", "first")] + [("assistant", "x")] * 2 + [("assistant", "é")]
    assert got[1].learned == ["x", "x", "é"] and [tuple(t) for t in got[None].back] == [("user", "no id")]
    assert [got[1].formatted[s.start:s.end] for s in got[1].loss_spans] == ["x", "x", "é"]
    assert chats.format_turns(df.limit(0)).collect() == []


def paths(messages):
    """All root-to-leaf paths of one tree, best first."""
    parent = {m: p if p in {x[0] for x in messages} else None for m, p, *_ in messages}
    said = {m: (role or "", text or "", score or 0.0) for m, _, role, text, score in messages}
    out = []
    for leaf in set(parent) - set(parent.values()):
        path, node = [], leaf
        while node is not None and node not in path:
            path.append(node)
            node = parent[node]
        if node is None:
            scores = [said[n][2] for n in path]
            out.append((sum(scores) / len(scores), [said[n][:2] for n in reversed(path)]))
    return out


def test_best_branches_of_trees(spark):
    rng = random.Random(11)
    trees, rows = {}, []
    for tree in [f"t{i}" for i in range(25)] + [None]:
        messages, size = [], rng.choice([1, 2, 6, 40, 150])
        for m in range(size):
            parent = None if m == 0 or rng.random() < 0.05 else rng.choice([rng.randrange(m), max(0, m - 1), 9999 if m > 30 else 0])
            messages.append((m, parent, rng.choice(["user", "assistant"]), rng.choice(ODD), float(rng.randrange(1, 99))))
        trees[tree] = messages
        rows += [(tree, *m, "x", "y") for m in messages]
    found = read(chats.format_trees(spark.createDataFrame(rows, TREE), branches=3), "tree_id", "branch")
    got = defaultdict(dict)
    for r in found:
        got[r.tree_id][r.branch] = (round(r.score, 9), [tuple(t) for t in r.back])
    for tree, messages in trees.items():
        want = sorted(paths(messages), key=lambda p: (-p[0], -len(p[1])))
        best = [got[tree][k] for k in sorted(got[tree])]
        assert [b[0] for b in best] == [round(s, 9) for s, _ in want[:3]]
        every = [(round(s, 9), turns) for s, turns in want]
        assert all(b in every for b in best)


def test_circles_many_answers_and_repeated_ids(spark):
    rows = [("c", 1, 2, "user", "round", 1.0, "", ""), ("c", 2, 1, "user", "and round", 1.0, "", ""),
            ("c", 3, 2, "user", "below", 1.0, "", ""), ("c", 4, None, "user", "alone", None, "", "")]
    rows += [("wide", 0, None, "user", "q", 0.0, "", "")]
    rows += [("wide", i, 0, "assistant", f"a{i}", float(i), "", "") for i in range(1, 3000)]
    rows += [("twice", 1, None, "user", "q", 1.0, "", ""), ("twice", 1, None, "user", "q", 1.0, "", ""),
             ("twice", None, 1, "assistant", "a", 2.0, "", "")]
    got = defaultdict(list)
    for r in sorted(read(chats.format_trees(spark.createDataFrame(rows, TREE), branches=2), "tree_id", "branch"),
                    key=lambda r: r.branch):
        got[r.tree_id].append([t.text for t in r.back])
    assert got == {"c": [["alone"]], "wide": [["q", "a2999"], ["q", "a2998"]], "twice": [["q", "q", "a"]]}
    assert chats.format_trees(spark.createDataFrame(rows, TREE).limit(0)).collect() == []
