"""Recall and exact scores against brute force; rows that take no part."""

import numpy as np
import pytest

from oddsflow.llm import kmeans_tree, queries
from oddsflow.llm.kmeans_tree import Tree, nearest


def brute(vectors, queries, k):
    ids = np.array(sorted(vectors))
    rows = np.array([vectors[i] for i in ids], float)
    norms = np.sqrt((rows * rows).sum(axis=1))
    out = {}
    for q in queries:
        at = np.searchsorted(ids, q)
        scores = (rows * rows[at]).sum(axis=1) / (norms * norms[at])
        scores[at] = -np.inf
        best = np.lexsort((ids, -scores))[:min(k, len(ids) - 1)]
        out[q] = [(int(ids[b]), float(scores[b])) for b in best]
    return out


def test_everything_visited_is_exact(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "BLOCK", 64)
    monkeypatch.setattr(kmeans_tree, "ASKED", 3)
    rng = np.random.default_rng(0)
    vectors = {i: rng.normal(size=8).astype(np.float32) for i in range(600)}
    for i in range(600, 900):  # a very common vector, and a scaled copy
        vectors[i] = vectors[7]
    vectors[901] = vectors[3] * 2
    odd = [(2000, None), (2050, [0.0] * 8), (2100, [1.0, None] + [0.0] * 6), (2150, [float("nan")] + [1.0] * 7), (2200, [float("inf")] + [1.0] * 7), (2250, [1.0, 2.0]), (2300, []), (None, [1.0] * 8)]
    rows = [(i, [float(x) for x in v]) for i, v in vectors.items()] + odd
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, leaf int, id int").repartition(5)
    got = {}
    for r in nearest(df, "id % 50 = 0", 5, recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = brute(vectors, [i for i in vectors if i % 50 == 0], 5)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.97 * sum(map(len, want.values()))
    exact = {(q, i): s for q in want for i, s in want[q]}
    assert all(abs(s - exact.get((q, i), s)) < 1e-12 for q in got for i, s in got[q])
    assert got[600] == want[600] and got[650] == want[650]  # copies: ties to the smaller id


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    df = spark.createDataFrame([(i * 50, [1.0, float(i)]) for i in range(n)], "vec_id long, embedding array<float>")
    out = nearest(df, "id % 50 = 0").collect()
    assert len(out) == n * (n - 1)


def test_tree_covers_every_vector():
    vectors = np.random.default_rng(2).normal(size=(3000, 6)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    tree = Tree(vectors)
    leaf = tree.assign(vectors)
    assert tree.leaves > 16 and set(leaf) <= set(range(tree.leaves))
    tree.counts = np.bincount(leaf, minlength=tree.leaves)
    assert sorted(tree.visit(vectors[0], tree.leaves, 0)) == sorted(set(leaf))
    assert tree.visit(vectors[0], 1, 1)[0] == tree.visit(vectors[0], 5, 1)[0]


def test_a_query_is_no_evidence_of_its_own_recall():
    vectors = np.random.default_rng(4).normal(size=(800, 6)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    tree = Tree(vectors)
    visits, leaf = tree.calibrate(vectors, 3, 0.9), tree.assign(vectors)
    hits = []
    for i in range(0, 800, 2):
        scores = vectors @ vectors[i]
        scores[i] = -np.inf
        hits += np.isin(leaf[np.argsort(-scores, kind="stable")[:3]], tree.visit(vectors[i], visits, 0)).tolist()
    assert 0.9 <= np.mean(hits) < 0.97
    assert Tree(vectors[:1]).calibrate(vectors[:1], 3, 0.9) == 1


@pytest.mark.parametrize("sample", [20_000, 400])
def test_query_recall(spark, monkeypatch, sample):
    monkeypatch.setattr(kmeans_tree, "SAMPLE", sample)  # 400: most rows are indexed by a tree that has not seen them
    sf = "/root/testdata/sf0.1" if sample == 400 else "/root/testdata/sf0.01"
    out = queries.queries()["op9_nearest_neighbours"](spark, sf).collect()
    vectors = {r.vec_id: np.array(r.embedding, np.float32) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    want = brute(vectors, [i for i in vectors if i % 50 == 0], 5)
    assert len(out) == sum(map(len, want.values()))
    assert sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in out) >= 0.9 * len(out)
