import random
from collections import Counter

from codesieve.llm import mixing


def edf(counts):
    """Slots of one period by a plain loop over released blocks."""
    period, done, out = sum(counts), [0] * len(counts), []
    for now in range(period):
        ready = [(-(-(done[k] + 1) * period // n), k) for k, n in enumerate(counts)
                 if done[k] < n and done[k] * period // n <= now]
        out.append(min(ready)[1])
        done[out[-1]] += 1
    return out


def schedule(spark, counts):
    slots = spark.createDataFrame([(f"s{k:03d}", n) for k, n in enumerate(counts)], "_source string, _slots int")
    return [int(r._source[1:]) for r in mixing.period_schedule(slots).orderBy("_at").collect()]


def test_schedule_against_a_loop_and_deviation(spark):
    random.seed(2)
    for counts in ([1], [3, 1], [5, 3, 2, 2], [random.randint(1, 40) for _ in range(12)]):
        got = schedule(spark, counts)
        assert got == edf(counts)
        done = Counter()
        for t, k in enumerate(got, 1):
            done[k] += 1
            assert all(abs(done[j] - n * t / sum(counts)) < 1 for j, n in enumerate(counts))


def test_every_row_once_in_blocks(docs):
    rows = [(i, "t", None, f"s{i % 7 % 3}" if i % 11 else None) for i in range(900)]
    got = mixing.mix(docs(*rows), block_rows=10, resolution=50).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in rows)
    assert len({(r.slot, r.place) for r in got}) == 900
    assert max(Counter((r.source, r.block) for r in got).values()) == 10
    blocks = sorted({(r.slot, r.source, r.block) for r in got}, key=lambda b: b[0])
    slots = {s: [b for _, x, b in blocks if x == s] for s in ("s0", "s1", "s2", None)}
    assert all(found == sorted(found) for found in slots.values())
    assert slots[None]  # a null source is a source of its own


def test_given_weights(spark, docs):
    rows = [(i, "t", None, "ab"[i % 2]) for i in range(400)] + [(1000, "t", None, "c"), (1001, "t", None, None)]
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 0.0), (None, None)], "s string, w double")
    got = mixing.mix(docs(*rows), weights, block_rows=1, resolution=4).collect()
    order = [r.source for r in sorted((r for r in got if r.slot is not None), key=lambda r: r.slot)]
    for t in range(1, 200):
        assert abs(order[:t].count("a") - 0.75 * t) < 1
    assert {r.source for r in got if r.slot is None} == {"c", None}
    assert len(got) == 402


def test_rows_in_order_with_their_columns(docs):
    rows = [(i, f"t{i}", None, "ab"[i % 2]) for i in range(300)] + [(5, "again", None, "b"), (None, "n", None, None)]
    df = docs(*rows)
    out = mixing.mixed_rows(df, block_rows=4)
    assert out.columns == df.columns
    found = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(found, key=str) == sorted([(r[0], r[1]) for r in rows], key=str)
    place = {(r.doc_id, r.source): (r.slot, r.place) for r in mixing.mix(df, block_rows=4).collect()}
    at = [place[(r.doc_id, r.source)] for r in out.collect() if r.doc_id != 5]
    assert at == sorted(at)


def test_empty_and_no_python(docs):
    empty = docs((1, "t")).limit(0)
    assert mixing.mix(empty).collect() == [] and mixing.mixed_rows(empty).collect() == []
    plan = mixing.mix(docs((1, "t")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_clashing_columns_and_position(docs):
    df = docs(*[(i, f"t{i}", None, "ab"[i % 2]) for i in range(60)])
    wide = df.selectExpr("*", "doc_id as _id", "source as _source", "text as _order", "1 as id", "2 as `from`",
                         "3 as at", "4 as row", "5 as slot", "6 as place", "7 as `a.b`")
    plain = [r.doc_id for r in mixing.mixed_rows(df, block_rows=4).collect()]
    out = mixing.mixed_rows(wide, block_rows=4)
    found = out.collect()
    assert out.columns == wide.columns and [r.doc_id for r in found] == plain
    assert all(r._id == r.doc_id and r._order == r.text and r.row == 4 for r in found)
    placed = mixing.mixed_rows(df, block_rows=4, position="mixed_at")
    assert placed.columns == [*df.columns, "mixed_at"]
    shuffled = placed.orderBy("doc_id").collect()
    assert [r.doc_id for r in sorted(shuffled, key=lambda r: r.mixed_at)] == plain
