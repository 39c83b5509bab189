import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abtforge.llm.topk import BallTree, quantised, scores, top_k

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.IntegerType())])


def brute(rows, k=5, step=50):
    sound = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in sound if i % step == 0}):
        a = min(v for i, v in sound if i == q)
        got = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in sound if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(got)]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).select("vec_id", quantised(F.col("embedding")).alias("vector"), "score")
    got = top_k(df, F.col("vec_id") % 50 == 0, **kw)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(tuple(r) for r in got.collect())


def test_matches_brute_force_with_ties_and_awkward_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 1) for i in range(1200)]
    rows += [(i, [0.5] * 8, 1) for i in range(1200, 1900)]  # one very common vector: ties by id
    rows += [(None, [1.0] * 8, 1), (2000, None, 1), (2001, [1.0, None], 1), (2002, [float("nan")] * 8, 1), (2003, [float("inf")] * 8, 1),
             (2050, [1.0, 2.0], 1), (2051, [], 1), (7, [float(x) for x in rng.normal(size=8)], 1)]
    assert run(spark, rows, leaf=16) == sorted(brute(rows))


def test_fewer_candidates_than_k_and_empty(spark):
    rows = [(0, [1.0], 1), (1, [2.0], 1), (50, [0.25], 1)]
    assert run(spark, rows) == sorted(brute(rows))
    assert run(spark, []) == []


def test_scores_beyond_doubles_are_exact():
    a = np.array([[1 << 40, 3]])
    b = np.array([[(1 << 20) + 1, 5], [1 << 62, 0]])
    assert scores(a, b).tolist() == [[(1 << 40) * ((1 << 20) + 1) + 15, (1 << 63) - 1]]


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 300), st.integers(1, 6), st.integers(0, 10_000))
def test_tree_equals_full_scan(n, k, seed):
    rng = np.random.default_rng(seed)
    ids, rows = np.arange(n) * 3, rng.integers(-4, 5, (n, 4))
    asked = rng.integers(-4, 5, (7, 4))
    q, found, score = BallTree(ids, rows, leaf=8).search(np.arange(7) * 3, asked, np.full(7, -(1 << 62)), k)
    full = scores(asked, rows)
    for at in range(7):
        want = sorted((-full[at, j], ids[j]) for j in range(n) if ids[j] != at * 3)[:k]
        assert [(-s, i) for s, i in zip(score[q == at], found[q == at])] == want
