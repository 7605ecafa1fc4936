from pyspark.sql import functions as F

from corpusmap.plans import dataset
from corpusmap.session import scratch_path
from corpusmap.sources import columns


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_groups_join_without_a_shuffle(spark):
    rows = spark.range(500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("id"), (F.col("id") * 2).alias("n"))
    paths = [scratch_path(spark, "it's") for _ in range(2)]
    columns.write_group(rows, paths[0], 7)
    columns.write_group(rows.select("id", (F.col("n") + 1).alias("m")), paths[1], 7)
    # as another session would find them, which knows no such table
    for path in paths:
        spark.sql(f"DROP TABLE {columns._name(path)}")
    read = [columns.read_group(spark, paths[0], rows.schema, 7), columns.read_group(spark, paths[1], rows.select("id", F.col("n").alias("m")).schema, 7)]
    both = columns.join_groups(read)
    assert "Exchange" not in _plan(both) and "SortMergeJoin" in _plan(both)
    assert both.filter("m = n + 1").count() == 500


def test_an_empty_group(spark):
    path, rows = scratch_path(spark, "none"), spark.createDataFrame([], "id int, x double")
    columns.write_group(rows, path, columns.buckets_for(0))
    assert columns.read_group(spark, path, rows.schema, 1).count() == 0
    assert columns.buckets_for(100_001) == 2 and columns.buckets_for(10**12) == columns.MAX_BUCKETS


def test_a_map_opens_only_what_is_wanted(spark):
    rows = spark.createDataFrame([(f"r{i}", f"word{i % 3} apple", i, "x") for i in range(9)], "key string, body string, n int, place string")
    m = dataset.map_data(
        spark, scratch_path(spark, "maps"), "d", rows, indexed_field="body", id_field="key",
        projection_options={"n_epochs": 1, "n_neighbors": 3}, topic_model={"sizes": (2,)},
        embedder=dataset.embed.hash_embedder(8),
    )
    found = m.data(["n", "x", "duplicate_class"])
    assert "Exchange" not in _plan(found) and found.columns == ["id", "n", "x", "duplicate_class"]
    opened = {f.split(m.path.rsplit("/", 1)[1] + "/")[1].split("/")[0] for f in found.inputFiles()}
    assert opened == {"fields", "projected", "duplicates"}
    assert "body" not in _plan(found) and "place" not in _plan(found).split("ReadSchema")[1]
    assert sorted(tuple(r) for r in m.data().collect()) == sorted((r.key, r.key, r.body, r.n, r.place) for r in rows.collect())
    assert m.data().columns == ["id", "key", "body", "n", "place"]
    assert {r.id: r.topic_depth_1 for r in m.data(["topic_depth_1"]).collect()} == {r.id: r.topic_depth_1 for r in m.topics.collect()}
    # a map holds its rows as they were when it was built
    m.dataset.delete_data(spark.createDataFrame([("r1",)], "key string"))
    assert m.data([]).count() == 9 and m.dataset.total_datums == 8
