import numpy as np

from cases import SMALL, table
from inkwell.llm import hnsw
from inkwell.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(ids, vectors, query, k):
    scores = sorted((-float(v @ vectors[query]), i) for i, v in zip(ids, vectors) if i != ids[query])
    return [(i, -s) for s, i in scores[:k]]


def test_recall_of_the_query(spark):
    rows = table("embeddings")
    ids = [r["vec_id"] for r in rows]
    vectors = np.array([r["embedding"] for r in rows], float)
    found = {}
    for r in QUERIES["op2_nearest"](spark, SMALL).collect():
        found.setdefault(r["query_id"], {})[r["vec_id"]] = (r["rank"], r["score"])
    hit = wanted = 0
    for place, i in enumerate(ids):
        if i % 20 == 0:
            best = brute(ids, vectors, place, 20)
            assert sorted(r for r, _ in found[i].values()) == list(range(1, len(best) + 1))
            for other, score in best:
                wanted += 1
                if other in found[i]:
                    hit += 1
                    assert abs(found[i][other][1] - score) < 1e-12
    assert hit >= 0.95 * wanted


def test_graph_recall_on_clusters_and_lengths():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    vectors = centres[rng.integers(0, 20, 1500)] + rng.normal(0, 0.1, (1500, 16))
    vectors *= rng.uniform(0.5, 2, (1500, 1))
    graph = hnsw.Graph.build(vectors)
    hit = sum(len(set(graph.nearest(q, 10)) & set(np.argsort(-(vectors @ q))[:10].tolist())) for q in vectors[::15])
    assert hit >= 0.9 * 1000


def test_flat_arrays_give_the_same_answers():
    vectors = np.random.default_rng(2).normal(size=(300, 8))
    graph = hnsw.Graph.build(vectors)
    flat = graph.flat()
    again = hnsw.Graph.load(vectors, flat["entry"], flat["level_of"], flat["nodes"], flat["offsets"], flat["neighbours"])
    assert all(graph.nearest(q, 5) == again.nearest(q, 5) for q in vectors[:50])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (3, [0.5, 0.5], "x"), (4, None, "x"),
        (5, [0.0, 0.0], "x"), (6, [nan, 1.0], "x"), (7, [inf, 1.0], "x"), (8, [None, 1.0], "x"), (9, [], "x"),
        (None, [1.0, 0.0], "x"), (10, [1.0, 2.0, 3.0], "x"), (20, [2.0, 2.0, 2.0], "x"),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA)
    index = hnsw.build_index(vectors, 2)
    found = hnsw.search(index, vectors, 2).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found if r["query_id"] in (0, 1, 3, 10)] == [
        (0, 1, 1, 1.0), (0, 2, 2, 1.0), (1, 1, 0, 1.0), (1, 2, 2, 1.0), (3, 1, 0, 0.5), (3, 2, 1, 0.5), (10, 1, 20, 12.0)]
    assert {r["query_id"] for r in found} == {0, 1, 2, 3, 10, 20}


def test_many_equal_vectors_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 40)
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 1.0, 0.0] if i % 3 == 0 else rng.normal(size=3).round(3).tolist(), "x") for i in range(300)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = hnsw.search(hnsw.build_index(vectors, 4), vectors.where("vec_id % 10 = 0"), 4).collect()
    exact = np.array([np.float32(v) for _, v, _ in rows], float)
    for q in range(0, 300, 10):
        got = [(r["vec_id"]) for r in sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])]
        want = [i for i, _ in brute(list(range(300)), exact, q, 4)]
        assert len(set(got) & set(want)) >= 3 and len(got) == 4


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hnsw.search(hnsw.build_index(empty, 3), empty, 3).count() == 0
