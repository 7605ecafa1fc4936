"""Search where queries must look into many cells: blocks meet, and no query is copied to the cells."""

import numpy as np
import pytest

from corpusmap.functions import blocks
from corpusmap.operators import cells, knn


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    kind = "string" if isinstance(ids[0], str) else "bigint"
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in zip(ids, x)], f"id {kind}, vector array<double>")


def brute(x, k, metric, ids, exclude_self):
    u = blocks.prepare(x, metric)
    squares = ((u[:, None] - u[None]) ** 2).sum(2)
    distance = {"l2": np.sqrt(squares), "cosine": squares / 2, "hamming": squares}[metric]
    if exclude_self:
        np.fill_diagonal(distance, np.inf)
    ids = np.array(ids)
    return {(ids[i], ids[j], r + 1) for i in range(len(x)) for r, j in enumerate(np.lexsort((ids, distance[i]))[:k])}


@pytest.mark.parametrize("metric, text, exclude_self", [("l2", False, False), ("cosine", True, True), ("hamming", False, True)])
def test_unclustered_queries_are_not_copied(spark, metric, text, exclude_self, monkeypatch):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(700, 10))
    x[:40] = x[0]
    ids = [f"r{i}" for i in rng.permutation(len(x))] if text else [int(i) for i in rng.permutation(len(x))]
    routed, before = [], cells.Cells.cells_within
    monkeypatch.setattr(cells.Cells, "cells_within", lambda self, q, probes: routed.append(q.count()) or before(self, q, probes))
    monkeypatch.setattr(cells, "QUERY_ROWS", 150)
    monkeypatch.setattr(cells, "BLOCK_ROWS", 120)
    df = frame(spark, x, ids)
    found = knn.join_nearest(df, df, 6, metric=metric, cell_rows=8, exclude_self=exclude_self).collect()
    assert {(r.query_id, r.neighbor_id, r.rank) for r in found} == brute(x, 6, metric, ids, exclude_self)
    assert len(found) == 6 * len(x)
    assert max(routed) <= 64


def test_many_copies_are_searched_once(spark):
    """Of 5,000 copies of each of four vectors, the search sees as many as it can name."""
    x = np.repeat(np.eye(4), 5000, axis=0)
    df = frame(spark, x)
    assert knn.few_copies(df, 4).count() == 16
    found = knn.neighbor_graph(df, 3, metric="cosine").filter("query_id in (0, 2, 4, 19999)").collect()
    got = {q: [r.neighbor_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 2, 4, 19999)}
    assert got == {0: [1, 2, 3], 2: [0, 1, 3], 4: [0, 1, 2], 19999: [15000, 15001, 15002]}


@pytest.mark.parametrize("far, bounded", [(0.0, True), (1e6, True), (1e20, True), (0.0, False)])
def test_rounded_products_lose_no_neighbour(far, bounded, monkeypatch):
    """Whatever the scale, where limits are tight, missing or met exactly, and where copies make many candidates of a query."""
    rng = np.random.default_rng(21)
    x = rng.normal(size=(1500, 12)) + far
    x[200:300] = x[200]
    q = x[rng.permutation(1500)[:700]] + rng.normal(size=(700, 12)) * 0.01
    q[:50] = x[200]
    rows, k, asked = np.arange(1500), 5, []
    want = np.sort(np.linalg.norm(q[:, None, :] - x[None], axis=2), axis=1)[:, k - 1]
    limit = want**2 if bounded else np.where(np.arange(700) % 2, np.inf, want**2)
    sure = blocks._surely_near
    monkeypatch.setattr(blocks, "_surely_near", lambda q, *more: asked.append(len(q)) or sure(q, *more))
    at, col, distance = blocks.nearest_in_block(q, x, k, "l2", rows, None, limit * (1 + 1e-9))
    every = blocks.nearest_in_block(q, x, k, "l2", rows)
    assert np.array_equal(at, every[0]) and np.array_equal(col, every[1]) and np.array_equal(distance, every[2])
    if far == 0.0 and bounded:
        assert 50 <= sum(asked) < 100  # only queries with many candidates have all their products worked out in full
