"""Nearest neighbours: exact scores, order and odd vectors; recall against brute force."""

import numpy as np
import pytest

from marketmill.llm import ann, queries


def brute(vectors, asked, k):
    out = {}
    for q in asked:
        scored = sorted(((-float(np.dot(vectors[q], vectors[i])), i) for i in vectors if i != q))
        out[q] = [i for _, i in scored[:k]]
    return out


def test_recall_and_scores(spark, sf_dir):
    data = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    vectors = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in data}
    want = brute(vectors, [i for i in vectors if i % 20 == 0], 20)
    got = {}
    for r in queries.QUERIES["op7_nn_descent"](spark, sf_dir).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in {v for _, v, _ in found}
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        assert all(s == pytest.approx(float(vectors[q] @ vectors[v]), abs=1e-12) for _, v, s in found)
        hits += len({v for _, v, _ in found} & set(want[q]))
    assert hits >= 0.95 * 20 * len(want)


def test_odd_vectors(rows):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [0.5, 3.0]), (3, [-1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [9.0, 0.0]), (9, [9.0, 0.0]), (40, [0.0, 0.0])]
    df = rows([(i, v, 7, "x") for i, v in data], "vec_id long, embedding array<float>, node int, score string")
    got = {}
    for r in ann.search(df, lambda i: i % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(x) for q, x in got.items()} == {
        0: [(1, 9, 9.0), (2, 1, 1.0), (3, 2, 1.0), (4, 20, 0.5), (5, 3, -1.0)],
        20: [(1, 9, 4.5), (2, 0, 0.5), (3, 1, 0.5), (4, 2, 0.5), (5, 3, -0.5)],
    }
    assert ann.search(df.filter("vec_id > 1000"), lambda i: i % 20 == 0).collect() == []


def test_many_equal_vectors(rows):
    data = [(i, [1.0, 0.5]) for i in range(200)] + [(i, [float(i % 7), 1.0]) for i in range(200, 230)]
    got = [r for r in ann.search(rows(data, "vec_id long, embedding array<float>"), lambda i: i == 40).orderBy("rank").collect()]
    vectors = {i: np.array(v) for i, v in data}
    assert [r.vec_id for r in got] == brute(vectors, [40], 20)[40]
