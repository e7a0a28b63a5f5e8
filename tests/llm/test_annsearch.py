import numpy as np
import pytest
from pyspark.sql import functions as F

from jobgrain.llm import annsearch, hnsw, queries
from tests.llm.helpers import SF


def brute(ids, vectors, asked, k):
    out = {}
    for a in np.flatnonzero(asked):
        product = (vectors * vectors[a]).sum(axis=1)
        product[a] = -np.inf
        best = np.lexsort((ids, -product))[: min(k, len(ids) - 1)]
        out[ids[a]] = list(zip(ids[best].tolist(), product[best]))
    return out


def recall(got, expected):
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in rows}) for q, rows in expected.items())
    return hits / sum(map(len, expected.values()))


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("dim, scale", [(8, False), (64, False), (24, True)])
def test_recall_of_random_vectors(dim, scale):
    r = np.random.default_rng(dim)
    vectors = r.standard_normal((3000, dim))
    if scale:  # lengths differ: largest products are not smallest angles
        vectors *= r.uniform(0.5, 2, (3000, 1))
    ids = np.arange(3000) * 7
    graph = hnsw.Graph.of_flat(hnsw.Graph.build(ids, vectors).flat())
    asked = ids % 20 == 0
    row, found, score = graph.nearest(ids[asked], vectors[asked], 20)
    got = {q: [] for q in ids[asked]}
    for a, b, c in zip(row, found, score):
        got[ids[asked][a]].append((b, c))
    assert recall(got, brute(ids, vectors, asked, 20)) >= 0.95


def test_query_recall_and_scores(spark):
    x = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    ids, vectors = x.vec_id.to_numpy(), np.array(x.embedding.tolist(), dtype=float)
    expected = brute(ids, vectors, ids % 20 == 0, 20)
    rows = annsearch.nearest_neighbours(
        spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), F.col("vec_id") % 20 == 0, shard_rows=1500
    ).collect()
    got = by_query(rows)
    assert set(got) == set(expected) and all(len(v) == 20 for v in got.values())
    assert recall(got, expected) >= 0.97
    exact = {i: v for i, v in zip(ids, vectors)}
    for q, found in list(got.items())[:50]:
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(np.isclose(s, exact[q] @ exact[v], rtol=1e-12) for v, s in found)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.5]), (4, None), (5, [0.0, 0.0]),
        (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (20, [1.0, 0.0, 0.0]), (0, [1.0, 0.0]),
        (40, [0.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = by_query(annsearch.nearest_neighbours(df, F.col("vec_id") % 20 == 0, k=3).collect())
    assert got == {0: [(1, 1.0), (2, 1.0), (3, 0.5)], 40: [(3, 0.5), (0, 0.0), (1, 0.0)]}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert annsearch.nearest_neighbours(empty, F.col("vec_id") % 20 == 0).collect() == []


def test_many_equal_vectors(spark):
    r = np.random.default_rng(1)
    rows = [(k, [1.0, 0.0, 0.0, 0.0]) for k in range(600)] + [
        (k, r.standard_normal(4).tolist()) for k in range(600, 900)
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = by_query(annsearch.nearest_neighbours(df, F.col("vec_id") % 20 == 0, shard_rows=300).collect())
    ids, vectors = np.array([k for k, _ in rows]), np.array([v for _, v in rows])
    assert recall(got, brute(ids, vectors, ids % 20 == 0, 20)) >= 0.97


def test_registered_query(spark):
    df = queries.op7_nearest_vectors(spark, SF)
    assert dict(df.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    n = spark.read.parquet(f"{SF}/embeddings.parquet").filter("vec_id % 20 = 0").count()
    assert df.count() == 20 * n
