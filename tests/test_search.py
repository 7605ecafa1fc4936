import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmap.functions import blocks, vectors
from corpusmap.operators import cells, knn


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    kind = "string" if isinstance(list(ids)[0], str) else "bigint"
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in zip(ids, x)], f"id {kind}, vector array<float>")


def brute(q, x, k, metric, exclude=False):
    q, x = np.float32(q).astype(float), np.float32(x).astype(float)
    out = {}
    for i, a in enumerate(q):
        if metric == "l2":
            d = np.sqrt(((x - a) ** 2).sum(1))
        elif metric == "cosine":
            d = 1 - x @ a / (np.linalg.norm(x, axis=1) * np.linalg.norm(a))
        elif metric == "dot":
            d = -(x @ a)
        else:
            d = ((x > 0) != (a > 0)).sum(1).astype(float)
        order = np.lexsort((np.arange(len(x)), np.round(d, 9)))
        out[i] = [(int(j), round(float(d[j]), 6)) for j in order if not (exclude and j == i)][:k]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.neighbor_id, round(r.distance, 6)))
    return out


def clustered(seed, n=400, d=8, copies=120):
    """A third of the rows are copies of one vector."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(6, d))[rng.integers(0, 6, n)] * 3 + rng.normal(size=(n, d))
    x[:copies] = x[0]
    return x


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot", "hamming"])
def test_scan_matches_brute_force(spark, metric):
    x = clustered(1)
    q = np.vstack([x[:2], np.random.default_rng(2).normal(size=(3, 8))])
    found = knn.search_by_vector(frame(spark, x).repartition(5), frame(spark, q), 7, metric=metric)
    assert result(found) == brute(q, x, 7, metric)


@pytest.mark.parametrize("metric", ["l2", "cosine", "hamming"])
def test_cell_join_is_exact_on_hot_groups(spark, metric, monkeypatch):
    monkeypatch.setattr(cells, "BLOCK_ROWS", 40)
    monkeypatch.setattr(cells, "QUERY_ROWS", 30)
    x = clustered(3)
    p = frame(spark, x)
    found = knn.join_nearest(p, p, 6, metric=metric, probes=2, pivots=20, exclude_self=True)
    assert result(found) == brute(x, x, 6, metric, exclude=True)


def test_cell_join_returns_short_lists(spark):
    x = clustered(4, n=5, copies=1)
    found = knn.join_nearest(frame(spark, x), frame(spark, x), 20, pivots=3, probes=1)
    assert {q: len(v) for q, v in result(found).items()} == dict.fromkeys(range(5), 5)


def test_recall_without_the_completing_pass(spark):
    x = clustered(5, n=600, copies=1)
    p = frame(spark, x)
    rough = result(knn.join_nearest(p, p, 10, probes=4, pivots=20, complete=False))
    exact = brute(x, x, 10, "l2")
    hits = sum(len({i for i, _ in rough[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert hits / (10 * len(exact)) >= 0.9


def test_many_queries_take_the_cell_join(spark, monkeypatch):
    monkeypatch.setattr(knn, "SCAN_QUERIES", 10)
    x = clustered(6, n=100, copies=30)
    assert result(knn.search_by_vector(frame(spark, x), frame(spark, x), 3)) == brute(x, x, 3, "l2")


def test_string_ids_and_self(spark):
    x = clustered(7, n=30, copies=1)
    names = [f"r{i:02d}" for i in range(30)]
    p = frame(spark, x, names)
    ids = spark.createDataFrame([("r03",)], "id string")
    with_self = knn.search_by_id(p, ids, 3).orderBy("rank").collect()
    assert with_self[0].neighbor_id == "r03" and with_self[0].distance == 0
    others = knn.search_by_id(p, ids, 3, include_self=False).orderBy("rank").collect()
    assert [r.neighbor_id for r in others[:2]] == [r.neighbor_id for r in with_self[1:]]
    assert [r["rank"] for r in others] == [1, 2, 3]


def test_arguments(spark):
    p = frame(spark, clustered(8, n=10, copies=1))
    for k in (0, 129):
        with pytest.raises(ValueError):
            knn.search_by_vector(p, p, k)
    with pytest.raises(ValueError):
        knn.search_by_vector(p, p, 1, metric="l1")
    ragged = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0, 3.0])], "id bigint, vector array<float>")
    with pytest.raises(Exception, match="length|broadcast|shape|mismatch"):
        knn.search_by_vector(ragged, p, 1).collect()


def test_posterior_sums_to_one(spark):
    x = clustered(9, n=60, copies=1)
    p = frame(spark, x)
    topics = p.select("id", (F.col("id") % 3).alias("t"))
    post = knn.topic_posterior(knn.search_by_vector(p, p.limit(4), 9), topics, "id", "t")
    sums = post.groupBy("query_id").agg(F.sum("probability").alias("s")).collect()
    assert len(sums) == 4 and all(abs(r.s - 1) < 1e-12 for r in sums)


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], [4.0, -3.0])], "a array<double>, z array<double>, b array<double>")
    a, z, b = F.col("a"), F.col("z"), F.col("b")
    got = df.select(
        vectors.norm(a), vectors.normalize(a), vectors.normalize(z), vectors.dot(a, b), vectors.cosine_distance(a, b),
        vectors.l2_distance(a, z), vectors.truncate_dims(a, 1), vectors.hamming_distance(vectors.binarize(a), vectors.binarize(b)),
    ).first()
    assert tuple(got) == (5.0, [0.6, 0.8], [0.0, 0.0], 0.0, 1.0, 5.0, [1.0], 1)


def test_many_dot_queries(spark, monkeypatch):
    """Products have no cells, so many queries take several scans."""
    monkeypatch.setattr(knn, "SCAN_QUERIES", 8)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(40, 4))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id int, vector array<double>")
    got = {(r.query_id, r.rank): r.neighbor_id for r in knn.search_by_vector(df, df, 3, metric="dot").collect()}
    order = np.argsort(-(v @ v.T), axis=1)[:, :3]
    first = min(rank for _, rank in got)
    assert all(got[i, first + j] == order[i, j] for i in range(40) for j in range(3))


def test_ragged_vectors():
    with pytest.raises(ValueError):
        blocks.matrix(pa.array([[1.0, 2.0], [1.0] * 6]))


def test_ties_are_bounded_by_k():
    same = np.ones((600, 8))
    at, col, distance = blocks.nearest_in_block(same, same, 5, "l2", np.arange(600)[::-1])
    assert len(at) == 3000 and set(col) == set(range(595, 600)) and not distance.any()
    at, col, _ = blocks.nearest_in_block(same[:2], same[:3], 2, "l2", np.array(["c", "a", "b"]), np.array(["a", "x"]))
    assert list(zip(at, col)) == [(0, 2), (0, 0), (1, 1), (1, 2)]


def test_cells_keep_their_size(spark):
    """At three sizes of clustered rows: cells stay small, and a query is compared with about as many rows."""
    from pyspark.sql import functions as F

    from corpusmap.operators import cells

    rng, per_query = np.random.default_rng(3), []
    for n in (1000, 4000, 16000):
        centres = rng.normal(size=(n // 20, 6)) * 10
        x = centres[rng.integers(len(centres), size=n)] + rng.normal(size=(n, 6))
        df = frame(spark, x)
        index = cells.Cells.over(df, "l2", cell_rows=32)
        sizes = [r["size"] for r in index.stats.select("size").collect()]
        assert sum(sizes) == n and len(sizes) >= n / 64 and max(sizes) <= 32 * 12
        first = index.nearest_cells(df, 4)
        met = first.join(index.stats.select("cell", "size"), "cell").agg(F.sum("size")).first()[0]
        near = cells.search_cells(first, index.homes, 5, "l2", False)
        bound = near.groupBy(F.col("query_id").alias("id")).agg(F.sort_array(F.collect_list("distance"))[4].alias("bound"))
        rest = index.cells_within(df.join(bound, "id", "left"), 4)
        met += rest.join(index.stats.select("cell", "size"), "cell").agg(F.sum("size")).first()[0] or 0
        per_query.append(met / n)
        index.discard()
    assert per_query[2] < 2 * per_query[0]


def test_empty_and_dot_blocks(spark, monkeypatch):
    from corpusmap.operators import cells

    x = np.random.default_rng(9).normal(size=(300, 5))
    empty = frame(spark, x).filter("false")
    assert knn.join_nearest(frame(spark, x), empty, 3).count() == knn.join_nearest(empty, frame(spark, x), 3).count() == 0
    monkeypatch.setattr(knn, "SCAN_QUERIES", 10)
    monkeypatch.setattr(cells, "QUERY_ROWS", 64)
    monkeypatch.setattr(cells, "BLOCK_ROWS", 50)
    repeated = frame(spark, x).selectExpr("id % 7 as id", "vector")  # more rows of one query id than a scan takes
    found = knn.search_by_vector(frame(spark, x), repeated, 4, metric="dot").collect()
    assert len(found) == 7 * 4
    scores = x @ x.T
    for q in range(7):
        rows = [r for r in found if r.query_id == q]
        want = sorted(-v for v in scores[q::7].ravel())[:4]
        assert np.allclose(sorted(r.distance for r in rows), want)
