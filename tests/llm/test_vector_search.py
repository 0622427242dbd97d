import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SMALL
from reportarium.llm import registry
from reportarium.llm.exact_topk import integers, scores, top_k
from reportarium.llm.posting_lists import Index, balanced_centroids, fit, nearest

INF, NAN = float("inf"), float("nan")
ODD = [
    (0, [1.0, 2.0]), (50, [1.0, 2.0]), (100, [0.0, 0.0]), (None, [1.0, 1.0]), (3, None), (4, []),
    (5, [NAN, 1.0]), (6, [INF, 0.0]), (7, [None, 1.0]), (8, [1.0, 2.0]), (9, [1.0, 2.0]),
    (9, [1.0, 2.0]), (10, [-1.0, 5.0]), (11, [1.0, 2.0, 3.0]), (12, [3.0, 1.0, 1.0]),
    (150, [1.0, 1.0, 1.0]),
]


def best(ids, values, is_query, k):
    """All scores of each query, sorted."""
    out = []
    for i in np.flatnonzero(is_query):
        others = sorted((-values[i] @ v, n) for n, v in zip(ids, values) if n != ids[i])[:k]
        out += [(ids[i], r, n, -s) for r, (s, n) in enumerate(others, 1)]
    return out


def loaded(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    return ids, np.array([r.embedding for r in rows], dtype=np.float64)


def odd(spark):
    rows = spark.createDataFrame(ODD, "vec_id long, embedding array<float>")
    return rows.withColumns({c: F.lit("x") for c in ("id", "v", "label", "score", "length")})


def test_exact_query_equals_brute_force(spark):
    folder = SMALL.replace("0.001", "0.01")
    ids, vectors = loaded(spark, folder)
    want = best(ids.tolist(), np.floor(256 * vectors), ids % 50 == 0, 5)
    got = registry.op9_exact_topk(spark, folder)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_many_small_blocks_and_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-1, 2, 3)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    values = np.floor(256 * np.array([v for _, v in rows]))
    want = best(list(range(120)), values, np.arange(120) % 3 == 0, 7)
    got = top_k(df, F.col("id") % 3 == 0, 7, block=9)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_exact_odd_rows(spark):
    got = top_k(odd(spark), F.col("id") % 50 == 0, 3).orderBy("query_id", "rank").collect()
    assert [tuple(r)[:3] for r in got] == [
        (0, 1, 10), (0, 2, 8), (0, 3, 9), (50, 1, 10), (50, 2, 0), (50, 3, 8),
        (100, 1, 0), (100, 2, 8), (100, 3, 9), (150, 1, 11), (150, 2, 12),
    ]
    assert top_k(odd(spark).limit(0), F.col("id") % 50 == 0, 3).collect() == []
    alone = odd(spark).filter("vec_id = 0")
    assert top_k(alone, F.col("id") % 50 == 0, 3).collect() == []


def test_scores_beyond_64_bits_end_there(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 2.0]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_k(df, F.col("id") == 0, 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 2**63 - 1), (3, 2**63 - 1), (2, -(2**63))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.floats(-1e12, 1e12), min_size=2, max_size=2), min_size=1, max_size=5))
def test_integer_scores_are_exact(rows):
    whole = integers(pa.array(rows, pa.list_(pa.float64())), 256)
    want = [[int(np.floor(x * 256)) for x in row] for row in rows]
    assert [[int(x) for x in row] for row in whole] == want
    clip = lambda x: min(max(x, -(2**63)), 2**63 - 1)
    assert scores(whole, whole).tolist() == [
        [clip(sum(a * b for a, b in zip(q, r))) for r in want] for q in want
    ]


def test_nearest_query_finds_the_nearest(spark):
    folder = SMALL.replace("0.001", "0.1")
    ids, vectors = loaded(spark, folder)
    want = {(q, n) for q, _, n, _ in best(ids.tolist(), vectors, ids % 20 == 0, 20)}
    rows = registry.op3_posting_lists(spark, folder).collect()
    assert len(want & {(r.query_id, r.vec_id) for r in rows}) >= 0.95 * len(want)
    by_id = dict(zip(ids.tolist(), vectors))
    for r in rows:
        assert r.score == pytest.approx(by_id[r.query_id] @ by_id[r.vec_id], abs=1e-12)
    for q in {r.query_id for r in rows}:
        own = sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)


def test_lists_alone_answer_beyond_the_sample(spark):
    """On a table several times the sample, of which brute force over the sample knows a quarter."""
    rng = np.random.default_rng(8)
    points = rng.normal(size=(60_000, 32))
    rows = spark.createDataFrame(pd.DataFrame({"vec_id": range(60_000), "embedding": points.tolist()}))
    found = nearest(rows, F.col("id") % 600 == 0, 20).collect()
    scores = points[::600] @ points.T
    scores[np.arange(100), np.arange(0, 60_000, 600)] = -np.inf
    want = {(q * 600, int(n)) for q, own in enumerate(np.argsort(-scores, axis=1)[:, :20]) for n in own}
    assert len(found) == 2000
    assert len(want & {(r.query_id, r.vec_id) for r in found}) >= 0.95 * 2000


@pytest.mark.parametrize("spread", [0.0, 1.0, 3.0])
def test_recall_on_many_lists(spread):
    rng = np.random.default_rng(int(spread * 10))
    centres = rng.normal(size=(30, 24)) * spread
    points = centres[rng.integers(0, 30, 9000)] + rng.normal(size=(9000, 24))
    points *= rng.uniform(0.5, 2, (9000, 1))
    index = fit(points[:3000], 90_000, np.sqrt((points**2).sum(1).max()), 20 * 10)
    assert len(index.centroids) > 100
    rows, lists = index.lists_of(points)
    stored = np.zeros((9000, len(index.centroids)), dtype=bool)
    stored[rows, lists] = True
    queries = points[-200:]
    visiting, visited = index.lists_for(queries)
    visits = np.zeros((200, len(index.centroids)), dtype=bool)
    visits[visiting, visited] = True
    true = np.argsort(-(queries @ points.T), axis=1)[:, :20]
    assert (stored[true] & visits[:, None, :]).any(axis=2).mean() >= 0.9


def test_walk_finds_the_nearest_centroids():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(4000, 16))
    index = fit(points, 4_000_000, 10.0, 20)
    far = ((index.lifted(points[:300])[:, None, :] - index.centroids) ** 2).sum(axis=2)
    lists, found = index.near(index.lifted(points[:300]), 32)
    assert all(len(set(row)) == len(row) for row in lists.tolist())
    assert (lists[:, 0] == far.argmin(axis=1)).mean() > 0.98
    assert np.allclose(found**2, np.take_along_axis(far, lists, 1))


def test_lists_are_balanced():
    points = np.random.default_rng(1).normal(size=(4096, 8))
    centres = balanced_centroids(points, 64)
    assert len(centres) == 64
    assert len(balanced_centroids(np.ones((500, 4)), 8)) == 8
    assert isinstance(fit(np.ones((500, 4)), 50_000, 2.0, 20), Index)


def test_nearest_odd_rows(spark):
    got = nearest(odd(spark), F.col("id") % 50 == 0, 3).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [
        (0, 1, 10, 9.0), (0, 2, 8, 5.0), (0, 3, 9, 5.0), (50, 1, 10, 9.0), (50, 2, 0, 5.0),
        (50, 3, 8, 5.0), (150, 1, 11, 6.0), (150, 2, 12, 5.0),
    ]
    assert nearest(odd(spark).limit(0), F.col("id") % 50 == 0, 3).collect() == []


def test_one_very_common_vector(spark):
    """A third of the rows are one vector: its list has many blocks, ties go to smaller ids."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).round(3).tolist() if i % 3 else [3.0] * 8) for i in range(9000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(df, F.col("id").isin(0, 3000), 4).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [
        (0, 3), (0, 6), (0, 9), (0, 12), (3000, 0), (3000, 3), (3000, 6), (3000, 9),
    ]
