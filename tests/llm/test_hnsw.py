"""Recall of the graphs against brute force, exact scores, ties, and rows that take no part."""

import numpy as np
import pytest

from orderloom.llm.hnsw import Graph, augmented, nearest_neighbours, op3_nearest


def brute(ids, x, query, k):
    score = x @ x[ids.index(query)]
    order = sorted((-s, i) for s, i in zip(score.tolist(), ids) if i != query)
    return [(i, -s) for s, i in order[:k]]


@pytest.mark.parametrize("kind", ["unit", "norms", "clusters"])
def test_recall_of_a_graph(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24))
    if kind == "clusters":
        x = rng.normal(size=(30, 24))[rng.integers(0, 30, 3000)] + 0.05 * x
    if kind != "norms":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = x[::50]
    found = Graph.build(augmented(x)).nearest(np.column_stack([q, np.zeros(len(q))]).astype(np.float32))[:, :]
    want = np.argsort(-(q @ x.T), axis=1)[:, :20]
    assert np.mean([len(set(w) & set(f)) / 20 for w, f in zip(want, found)]) > 0.95


@pytest.mark.parametrize("small", [{}, {"shard_size": 300, "asked_at_once": 40}], ids=["one", "several"])
def test_recall_on_the_table(spark, small):
    """The 2,000 vectors in one shard, and in seven whose queries come in three parts."""
    sf = "/root/testdata/sf0.1"
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    found = nearest_neighbours(vectors, vectors.filter("vec_id % 20 = 0"), **small) if small else op3_nearest(spark, sf)
    rows = found.collect()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in table], np.array([r.embedding for r in table], np.float64)
    hits = 0
    queries = [i for i in ids if i % 20 == 0]
    by = {}
    for r in rows:
        by.setdefault(r.query_id, []).append(r)
    assert sorted(by) == queries
    for q in queries:
        got = sorted(by[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 21))
        for r in got:
            assert abs(r.score - float(x[ids.index(q)] @ x[ids.index(r.vec_id)])) < 1e-12
        hits += len({r.vec_id for r in got} & {i for i, _ in brute(ids, x, q, 20)})
    print("recall", hits / (20 * len(queries)))
    assert hits / (20 * len(queries)) >= 0.9


def test_ties_and_rows_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.5]) for i in range(100, 0, -1)] + [(0, [2.0, 0.0]), (0, [2.0, 0.0]), (200, [1.0, 0.5]), (201, [0.1, 3.0])]
    rows += [(300, None), (301, [0.0, 0.0]), (302, [nan, 1.0]), (303, [inf, 1.0]), (304, [None, 1.0]), (305, []), (None, [1.0, 1.0]), (306, [1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    out = nearest_neighbours(df, df.filter("vec_id in (0, 20, 200, 300, 306)"), k=20)
    by = {}
    for r in sorted(out.collect(), key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(by) == [0, 20, 200]
    assert by[0] == [(i, 2.0) for i in range(1, 21)]
    # [1, .5] against itself is 1.25, against [2, 0] it is 2, against [.1, 3] it is 1.6
    assert [i for i, _ in by[20]] == [0, 201, *range(1, 19)]
    assert [i for i, _ in by[200]] == [0, 201, *range(1, 19)]
    split = nearest_neighbours(df, df.filter("vec_id in (0, 20, 200, 300, 306)"), k=20, shard_size=1, asked_at_once=1)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, out.collect()))
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    shared = nearest_neighbours(twice, twice.filter("vec_id = 1"), k=5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in shared] == [(2, 2.0), (2, 1.0)]
    few = df.filter("vec_id in (1, 2)")
    assert [(r.query_id, r.vec_id) for r in nearest_neighbours(few, few.filter("vec_id = 1")).collect()] == [(1, 2)]
    assert nearest_neighbours(df.limit(0), df.limit(0)).count() == 0
