import math

import numpy as np
import pytest

from codesieve.llm import hnsw


def brute(rows, queries, k):
    """Exact neighbours of queries by all distances."""
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(np.array(v, dtype=np.float32).astype(float))
    out = {}
    for q in {q for q, _ in queries if q in good}:
        best = sorted((min(float(np.sqrt(((a - b) ** 2).sum())) for a in good[q] for b in good[i] if len(a) == len(b)), i)
                      for i in good if i != q and any(len(a) == len(b) for a in good[q] for b in good[i]))
        out[q] = [i for _, i in best[:k]]
    return out


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows],
                                     "vec_id long, embedding array<float>, rank int, score double").repartition(3)
    return make


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append(r.vec_id)
    return out


def test_recall_over_shards(table):
    random = np.random.default_rng(3)
    centres = random.normal(size=(8, 16))
    rows = [(i, (centres[i % 8] + 0.6 * random.normal(size=16)).astype(np.float32).tolist()) for i in range(1200)]
    df = table(rows)
    got = found(hnsw.nearest_neighbours(df, df.where("vec_id % 40 = 0"), shard_rows=500))
    want = brute(rows, [r for r in rows if r[0] % 40 == 0], 10)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.95 * 10 * len(want)


def test_ties_copies_bad_vectors_and_lengths(table):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(40, 10, -1)] + [(i, [1.0, 2.0, 3.0 + i]) for i in range(1, 6)]
    rows += [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [nan, 1.0, 1.0]), (104, [inf, 0.0, 1.0]),
             (105, [1.0, None, 2.0]), (106, [1.0, 2.0]), (107, [1.0, 2.0]), (108, [5.0] * 7), (None, [1.0, 2.0, 3.0]),
             (20, [1.0, 2.0, 3.0])]
    df = table(rows)
    assert found(hnsw.nearest_neighbours(df, df)) == {q: v for q, v in brute(rows, rows, 10).items() if v}


def test_scores_are_exact_and_empty_tables(table):
    rows = [(1, [1.0, 0.1]), (2, [0.3, 0.7]), (3, [-1.0, 2.5])]
    df = table(rows)
    got = {(r.query_id, r.vec_id): r.score for r in hnsw.nearest_neighbours(df, df.where("vec_id = 1")).collect()}
    a, b = (np.array(rows[k][1], dtype=np.float32).astype(float) for k in (0, 2))
    assert set(got) == {(1, 2), (1, 3)} and abs(got[1, 3] - np.sqrt(((a - b) ** 2).sum())) < 1e-12
    assert hnsw.nearest_neighbours(df.limit(0), df.limit(0)).collect() == []
    assert hnsw.nearest_neighbours(df, df.limit(0)).collect() == []
