"""Vector search against brute force: recall, exact scores, ties, copies, odd vectors."""

import numpy as np

from cohort_engine.llm.vector_search import Graph, nearest


def brute(ids, v, q, k):
    s = (v * v[np.flatnonzero(ids == q)[0]]).sum(axis=1)
    s[ids == q] = -np.inf
    return [(int(ids[i]), s[i]) for i in np.lexsort((ids, -s))[:k] if np.isfinite(s[i])]


def frame(spark, ids, v):
    rows = [(int(i), [float(x) for x in r], 1, 2) for i, r in zip(ids, v)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score int")


def test_recall_of_lengths_and_clusters(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(20, 24))[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 24)) * 0.4
    v = (v * rng.uniform(0.3, 3, (1500, 1))).astype(np.float32).astype(float)        # inner product is not an angle here
    ids = np.arange(1500) * 3
    rows = frame(spark, ids, v)
    got = nearest(rows, rows.where("vec_id % 30 = 0"), 10, shard_rows=300).toPandas()
    hits = total = 0
    for q, g in got.groupby("query_id"):
        want = brute(ids, v, q, 10)
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 11)) and q not in set(g["vec_id"])
        assert np.allclose(g["score"], [(v[ids == q][0] * v[ids == i][0]).sum() for i in g["vec_id"]], rtol=0, atol=1e-12)
        assert [tuple(x) for x in sorted(zip(-g["score"], g["vec_id"]))] == list(zip(-g["score"], g["vec_id"]))
        hits += len({i for i, _ in want} & set(g["vec_id"]))
        total += 10
    assert hits / total >= 0.95


def test_a_third_are_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(600, 8)).astype(np.float32).astype(float)
    v[::3] = v[0]
    ids = np.arange(600)
    rows = frame(spark, ids, v)
    got = nearest(rows, rows.where("vec_id in (0, 3, 1)"), 20, shard_rows=150)
    for q in (0, 3):
        have = [(r.vec_id, r.score) for r in got.where(f"query_id = {q}").orderBy("rank").collect()]
        want = brute(ids, v, q, 20)
        assert [s for _, s in have] == [s for _, s in want]
        assert [i for i, _ in have] == [i for i, _ in want]


def test_odd_vectors(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]),
                                  (7, [float("inf"), 1.0]), (8, [0.5, 0.5]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (10, [0.0, 1.0])],
                                 "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank, r.vec_id, r.score) for r in nearest(rows, rows, 5).collect()}
    assert got == {(1, 1, 8, .5), (1, 2, 10, 0.0), (8, 1, 1, .5), (8, 2, 10, .5), (10, 1, 8, .5), (10, 2, 1, 0.0)}
    assert nearest(rows.limit(0), rows, 5).count() == 0 and nearest(rows, rows.limit(0), 5).count() == 0


def test_repeated_query_rows_are_asked_once(spark, monkeypatch):
    from cohort_engine.llm import vector_search as V
    monkeypatch.setattr(V, "QUERY_BLOCK", 3)
    monkeypatch.setattr(V, "BLOCKS", 2)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(200, 6)).astype(np.float32).astype(float)
    ids = np.arange(200)
    rows = frame(spark, ids, v)
    got = nearest(rows, rows.where("vec_id % 20 = 0").unionByName(rows.where("vec_id = 40")), 7, shard_rows=60).toPandas()
    assert got.groupby("query_id")["rank"].apply(lambda r: sorted(r) == list(range(1, 8))).all() and got["query_id"].nunique() == 10
    for q, g in got.groupby("query_id"):
        assert g.sort_values("rank")["vec_id"].tolist() == [i for i, _ in brute(ids, v, q, 7)]


def test_every_node_can_be_found():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = Graph(x, 1).build()
    found = g.search(x, 48)
    assert (found[:, 0] == np.arange(900)).mean() > 0.995
    assert all((f < 900).all() and (f >= -1).all() for f in g.flat)
