import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmap.operators import knn, projection, tiles, topics


def points(spark, n=240, d=10, seed=1, groups=6):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, d)) * 4
    kind = rng.integers(0, groups, n)
    x = centre[kind] + rng.normal(size=(n, d))
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id bigint, vector array<double>"), x, kind


def trust(x, y, k=10):
    """Trustworthiness: 1 minus the penalty for map neighbours that are far apart in the data."""
    n = len(x)
    far = np.argsort(np.argsort(((x[:, None] - x[None]) ** 2).sum(2), axis=1), axis=1)
    near = np.argsort(((y[:, None] - y[None]) ** 2).sum(2), axis=1)[:, 1 : k + 1]
    penalty = np.maximum(0, np.take_along_axis(far, near, 1) - k).sum()
    return 1 - 2 * penalty / (n * k * (2 * n - 3 * k - 1))


def test_layout_keeps_neighbours_better_than_axes(spark):
    df, x, _ = points(spark)
    start = projection.principal_axes(df).orderBy("id").collect()
    moved = projection.project(df, projection.ProjectionOptions(n_neighbors=10, n_epochs=12)).orderBy("id").collect()
    assert [r.id for r in moved] == list(range(len(x)))
    a, b = (np.array([(r.x, r.y) for r in rows]) for rows in (start, moved))
    assert np.isfinite(b).all()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert trust(unit, b) > trust(unit, a)


def test_levels(spark):
    """Several levels give about the quality of all epochs over all rows, whichever task does the coarsest."""
    df, x, _ = points(spark)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    options = projection.ProjectionOptions(n_neighbors=10, n_epochs=12)
    edges = projection.edge_weights(knn.neighbor_graph(df, 10, metric="cosine"))
    start = projection.principal_axes(df)
    quality = {}
    for base in (len(x), len(x) // 4):
        rows = projection.multilevel(start, edges, options, base_rows=base).orderBy("id").collect()
        assert [r.id for r in rows] == list(range(len(x)))
        quality[base] = trust(unit, np.array([(r.x, r.y) for r in rows]))
    flat = trust(unit, np.array([(r.x, r.y) for r in projection.layout(start, edges, options).orderBy("id").collect()]))
    assert quality[len(x)] > flat - 0.02 and quality[len(x) // 4] > flat - 0.05, (quality, flat)


def test_coarser(spark):
    edges = spark.createDataFrame([(1, 2, 3.0), (2, 3, 1.0), (4, 5, 2.0), (5, 6, 1.0), (3, 6, 0.1)], "a int, b int, w double")
    nodes = spark.createDataFrame([(i,) for i in range(1, 8)], "id int")
    got = {r.id: r.parent for r in projection.coarser(nodes, edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 7}
    alone = projection.multilevel(nodes.selectExpr("id", "double(id) as x", "0d as y"), edges.filter("false"), projection.ProjectionOptions(n_epochs=1), base_rows=2)
    assert alone.count() == 7


def test_local_neighbours(spark):
    g = spark.createDataFrame([(1, 2, 0.5, 1), (1, 3, 0.6, 2), (2, 3, 0.5, 1), (3, 2, 0.5, 1)], "query_id int, neighbor_id int, distance double, rank int")
    whole, local = ({(r.a, r.b): r.w for r in projection.edge_weights(g, n, 0.25).collect()} for n in (None, 1))
    assert local[(1, 3)] == pytest.approx(whole[(1, 3)] * 0.25) and local[(1, 2)] == whole[(1, 2)]
    with pytest.raises(ValueError):
        projection.project(g, projection.ProjectionOptions(model="other"))


def test_coincident_points_in_tiles(spark):
    """Rows at one place fill a tile on every level; the deepest takes the rest."""
    df = spark.range(60).selectExpr("id", "if(id < 55, 0.5, id / 60d) as x", "0.5d as y")
    found = tiles.quadtree(df, 4, 9).groupBy("level", "tile").count().collect()
    sizes = {level: max(r["count"] for r in found if r.level == level) for level in range(10)}
    assert all(sizes[level] <= 4 for level in range(9)) and sum(r["count"] for r in found) == 60 and sizes[9] > 4


def test_edge_weights_are_symmetric(spark):
    g = spark.createDataFrame([(1, 2, 0.5), (1, 3, 1.0), (2, 1, 0.5), (3, 1, 1.0)], "query_id int, neighbor_id int, distance double")
    got = {(r.a, r.b): r.w for r in projection.edge_weights(g).collect()}
    assert got[(1, 2)] == 1.0 and 0 < got[(1, 3)] <= 1.0 and len(got) == 2


@pytest.mark.parametrize("rows", [1, 7, 50])
def test_tiles(spark, rows):
    rng = np.random.default_rng(2)
    xy = rng.normal(size=(300, 2))
    xy[:100] = xy[0]  # a third of the points coincide
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "id bigint, x double, y double")
    got = tiles.quadtree(df, rows, max_level=6).collect()
    assert sorted(r.id for r in got) == list(range(300))
    low, high = xy.min(0), xy.max(0)
    sizes = {}
    for r in got:
        level, c, row = map(int, r.tile.split("/"))
        assert level == r.level
        sizes[r.tile] = sizes.get(r.tile, 0) + 1
        for v, cell, lo, hi in ((r.x, c, low[0], high[0]), (r.y, row, low[1], high[1])):
            share = (v - lo) / (hi - lo)
            assert cell / 2**level <= share + 1e-12 and share <= (cell + 1) / 2**level + 1e-12
    assert all(n <= rows for t, n in sizes.items() if not t.startswith("6/"))
    for tile in sizes:  # a parent is full before its children hold anything
        level, c, r = map(int, tile.split("/"))
        if level:
            assert sizes[f"{level - 1}/{c // 2}/{r // 2}"] == rows


def test_one_point_and_tile_files(spark, tmp_path):
    from corpusmap.sources import sinks

    df = spark.createDataFrame([(1, 0.0, 0.0)], "id bigint, x double, y double")
    tiled = tiles.quadtree(df)
    sinks.write_tiles(tiled, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.first()["tile"] == "0/0/0" and tiles.manifest(back).first()["n"] == 1


def test_region(spark):
    square_with_notch = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)]
    pts = [(1, 1.0, 1.0), (2, 2.0, 3.0), (3, 3.5, 1.0), (4, 9.0, 9.0), (5, -1.0, 2.0)]
    df = spark.createDataFrame(pts, "id int, x double, y double")
    assert sorted(r.id for r in tiles.select_region(df, square_with_notch).collect()) == [1, 3]
    with pytest.raises(ValueError):
        tiles.select_region(df, [(0, 0), (1, 1)])


@pytest.mark.parametrize("nested", [False, True])
def test_topic_model(spark, nested):
    df, _, kind = points(spark)
    texts = df.select("id", F.concat(F.lit("common "), F.when(F.col("id") % 2 == 0, "even").otherwise("odd")).alias("text"))
    coded, stored = topics.build_topics(df, texts, (3, 6), enforce_hierarchy=nested)
    meta = topics.metadata(stored).collect()
    rows = coded.collect()
    assert len(rows) == 240 and all(r.topic_depth_1 is not None and r.topic_depth_2 is not None for r in rows)
    assert not {r.topic_depth_1 for r in rows} & {r.topic_depth_2 for r in rows}
    for depth in (1, 2):
        labels = [m.topic_short_description for m in meta if m.depth == depth]
        assert len(labels) == len(set(labels)) > 1
    parents = {}
    for r in rows:
        parents.setdefault(r.topic_depth_2, set()).add(r.topic_depth_1)
    if nested:
        assert all(len(p) == 1 for p in parents.values())
    labelled = topics.label_topics(coded, topics.metadata(stored))
    assert labelled.filter("topic_depth_1 IS NULL OR topic_depth_2 IS NULL").count() == 0


def test_topics_without_texts(spark):
    df, _, _ = points(spark, n=40)
    _, stored = topics.build_topics(df, None, (2,))
    assert all(m.topic_short_description == str(m.topic_id) for m in topics.metadata(stored).collect())


def test_topic_options(spark):
    df, _, _ = points(spark, n=10)
    with pytest.raises(ValueError):
        topics.fit_topics(df, (4, 2))
    with pytest.raises(ValueError):
        topics.fit_topics(df, (2,), cluster_method="slow")
    rows = spark.createDataFrame([(1, "a", None)], "id int, topic_depth_1 string, topic_depth_2 string")
    for depth in (0, 3):
        with pytest.raises(ValueError):
            topics.in_topic(rows, "a", depth)


def test_hierarchy_skips_nulls(spark):
    meta = spark.createDataFrame([("a", None), ("a", "b"), ("a", "b"), (None, "c")], "topic_depth_1 string, topic_depth_2 string")
    assert [tuple(r) for r in topics.hierarchy(meta).collect()] == [("a", 1, "b")]


def test_density_counts_null_topics(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (1, 'a', 'x', TIMESTAMP_NTZ '2020-01-01'), (2, null, 'a', TIMESTAMP_NTZ '2020-01-02'), "
        "(3, 'a', 'x', TIMESTAMP_NTZ '2020-02-01') AS t(id, topic_depth_1, topic_depth_2, ts)"
    )
    got = topics.topic_density(rows, "ts", "2020-01-01", "2020-01-31", collapse=True).collect()
    assert [tuple(r) for r in got] == [("a", 2), (None, 1), ("x", 1)]


def test_short_labels_grow_until_unique(spark):
    words = [(1, 1, "cat", "big"), (1, 2, "cat", "small"), (1, 3, "dog", "big"), (2, 4, "cat", "big")]
    rows = [(d, t, r, w, 1.0) for d, t, *ws in words for r, w in enumerate(ws, 1)]
    df = spark.createDataFrame(rows, "depth int, topic int, rank int, word string, score double")
    got = {r.topic: r.topic_short_description for r in topics.describe_topics(df).collect()}
    assert got == {1: "cat / big", 2: "cat / small", 3: "dog", 4: "cat"}
