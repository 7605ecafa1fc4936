import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmap.operators import embed
from corpusmap.operators.checks import RowError
from corpusmap.operators.schema import SchemaError
from corpusmap.plans import dataset, options
from corpusmap.session import scratch_path

FAST = {"projection_options": {"n_epochs": 1, "n_neighbors": 3}, "topic_model": {"sizes": (2, 4)}, "embedder": embed.hash_embedder(32)}
TEXTS = ["red apple pie", "green apple tart", "fast blue car", "slow red car", "fast blue car", "old green bike", "new bike", "pie"]


@pytest.fixture
def root(spark):
    return scratch_path(spark, "datasets")


def table(spark, texts=TEXTS):
    return spark.createDataFrame([(f"id{i}", t, i) for i, t in enumerate(texts)], "id string, text string, n int")


def test_text_map(spark, root):
    m = dataset.map_data(spark, root, "me/fruit", table(spark), indexed_field="text", id_field="id", **FAST)
    d = m.dataset
    assert d.total_datums == 8 and d.modality == "text" and d.fields == ["id", "text", "n"]
    assert m.latent.count() == m.projected.count() == m.tiles.count() == m.topics.count() == 8
    assert [r.id for r in m.deletion_candidates().collect()] == ["id4"]
    found = m.vector_search(ids=["id2"], k=2).orderBy("rank").collect()
    assert [r.neighbor_id for r in found] == ["id2", "id4"] and found[1].distance == 0
    assert {r.n for r in m.group_by_topic(1).collect()} and m.topic_hierarchy.count() >= 2
    query = spark.createDataFrame([(0, m.latent.filter("id = 'id0'").first()["vector"])], "id int, vector array<double>")
    assert abs(m.vector_search_topics(query, k=4, depth=2).agg(F.sum("probability")).first()[0] - 1) < 1e-9
    assert m.place(query, k=1).first()["x"] == m.projected.filter("id = 'id0'").first()["x"]
    with pytest.raises(SchemaError):
        m.data(["none"])
    assert m.data(["n"]).columns == ["id", "n"]
    # Reopened from its folder alone.
    again = dataset.Dataset(spark, root, "me/fruit").get_map()
    assert again.path == m.path and d.get_map("me/fruit").path == m.path
    with pytest.raises(ValueError):
        dataset.map_data(spark, root, "me/fruit", table(spark), indexed_field="text", id_field="id", **FAST)


def test_progressive_adds_deletes_and_reuse(spark, root):
    m = dataset.map_data(spark, root, "d", table(spark), indexed_field="text", id_field="id", **FAST)
    d = m.dataset
    d.add_data(spark.createDataFrame([("id7", "changed", 1), ("id8", "", None)], "id string, text string, n bigint"))
    assert d.total_datums == 9
    assert d.get_data(["id8"]).first()["text"] == "null" and d.get_data(["id7"]).first()["text"] == "pie"
    d.delete_data(["id0", "id1"])
    assert d.total_datums == 7 and m.projected.count() == 8
    calls = spark.sparkContext.accumulator(0)

    def counting(c):
        @F.pandas_udf("array<double>")
        def count(s):
            calls.add(len(s))
            return s.map(lambda t: [0.0] * 31 + [1.0])

        return count(c)

    again = d.create_index("second", "text", reuse_from=m, **{**FAST, "embedder": counting})
    assert again.latent.count() == 7 and len(d.maps) == 2
    assert calls.value == 1  # only the new row


def test_tags_of_a_map(spark, root):
    m = dataset.map_data(spark, root, "d", table(spark), indexed_field="text", id_field="id", **FAST)
    assert m.tags.count() == 0
    m.add_tags(spark.createDataFrame([("id1",), ("id2",)], "id string"), ["good"])
    m.remove_tags(spark.createDataFrame([("id1",)], "id string"), ["good"])
    assert {r.id: r.good for r in m.tag_table().collect()} == {f"id{i}": i == 2 for i in range(8)}


def test_vectors_without_rows(spark, root):
    x = np.random.default_rng(1).normal(size=(30, 6))
    m = dataset.map_data(spark, root, "v", embeddings=x, **{**FAST, "embedder": None})
    ids = [r[0] for r in m.latent.select("id").collect()]
    assert len(set(ids)) == 30 and m.topics.count() == 30


def test_made_up_ids_stay_unique_over_loads(spark, root):
    d = dataset.Dataset.create(spark, root, "t", modality="text")
    d.add_data([{"text": f"t{i}"} for i in range(20)])
    d.add_data([{"text": f"u{i}"} for i in range(20)])
    assert d.data.select(d.key).distinct().count() == 40


@pytest.mark.parametrize(
    "rows, error",
    [
        ([(None, "a")], RowError), ([("x" * 100, "a")], RowError),
    ],
)
def test_bad_ids_leave_nothing_behind(spark, root, rows, error):
    bad = spark.createDataFrame(rows, "id string, text string")
    with pytest.raises(error):
        dataset.map_data(spark, root, "bad", bad, indexed_field="text", id_field="id", **FAST)
    assert not dataset.Dataset.exists(spark, root, "bad")
    good = dataset.open_or_create(spark, root, "bad", "text", "other")  # a retry may take other arguments
    assert good.total_datums == 0 and good.id_field == "other"
    with pytest.raises(ValueError, match="holds text rows"):
        dataset.open_or_create(spark, root, "bad", "embedding", "other")


def test_one_row_per_id_and_one_dimension(spark, root):
    d = dataset.Dataset.create(spark, root, "v", modality="embedding", id_field="id")
    rows = lambda *r: spark.createDataFrame(list(r), "id int, _embeddings array<float>")
    d.add_data(rows((1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])))
    assert d.total_datums == 2
    d.add_data(rows((2, [0.0, 1.0])))
    with pytest.raises(RowError, match="dimension differs"):
        d.add_data(rows((3, [1.0, 0.0, 0.0])))
    assert d.total_datums == 2


def test_broken_loads_leave_no_files(spark, root):
    """Rules are evaluated while rows are written; what broke one is gone from the folder, too."""
    d = dataset.Dataset.create(spark, root, "checked", modality="text", id_field="id")
    d.add_data(table(spark))
    files = lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{d.path}/rows").count()
    before = files()
    with pytest.raises(RowError) as found:
        d.add_data(spark.createDataFrame([("x" * 40, "a", 1), ("y" * 50, "b", 2), ("z", "c", 3)], "id string, text string, n int"))
    assert found.value.problems == [("id too long", "id", 2)]
    assert files() == before and d.total_datums == 8


def test_usage_and_pieces(spark, root):
    """The embedder's texts and tokens are counted as it takes them; pieces are pooled to one vector a row."""
    d = dataset.Dataset.create(spark, root, "counted", modality="text", id_field="id")
    d.add_data(spark.createDataFrame([("a", "one two three four"), ("b", None), ("c", "five")], "id string, text string"))
    quick = {"embedder": embed.hash_embedder(32), "projection_options": {"n_epochs": 0}, "topic_model": False, "duplicate_detection": False}
    whole = d.create_index("whole", "text", **quick)
    assert whole.usage == {"model": "hash", "texts": 3, "total_tokens": 6}
    pieces = d.create_index("pieces", "text", embedding_options={"model": "small", "chunk_chars": 8}, **quick)
    assert pieces.usage == {"model": "small", "texts": 5, "total_tokens": 7}
    rows = {r.id: r.vector for r in pieces.table("embeddings").collect()}
    assert set(rows) == {"a", "b", "c"} and all(abs(sum(x * x for x in v) - 1) < 1e-9 for v in rows.values())
    again = d.create_index("again", "text", reuse_from=whole, **quick)
    assert again.usage["texts"] == 0 and d.get_map("whole").usage == whole.usage


def test_bad_builds(spark, root):
    with pytest.raises(ValueError, match="empty"):
        dataset.map_data(spark, root, "e", embeddings=np.zeros((0, 3)))
    with pytest.raises(ValueError, match="not both"):
        dataset.map_data(spark, root, "e", table(spark), np.zeros((8, 3)), table(spark))
    with pytest.raises(ValueError, match="image embedder"):
        dataset.map_data(spark, root, "e", table(spark), blobs=table(spark), id_field="id")
    with pytest.raises(ValueError, match="not a field"):
        dataset.map_data(spark, root, "m", table(spark), indexed_field="story", id_field="id", **FAST)
    d = dataset.Dataset(spark, root, "m")
    with pytest.raises(ValueError, match="needs an indexed_field"):
        d.create_index()
    with pytest.raises(ValueError, match="no such map"):
        d.get_map()
    with pytest.raises(ValueError, match="no dataset"):
        dataset.Dataset(spark, root, "none")
    nan = spark.createDataFrame([(1, [float("nan")])], "id int, _embeddings array<float>")
    with pytest.raises(RowError, match="invalid component"):
        dataset.map_data(spark, root, "n", nan, id_field="id")


def test_image_map(spark, root):
    rows = spark.createDataFrame([(i, f"picture {i}") for i in range(6)], "id int, description string")
    blobs = spark.createDataFrame([(i, bytes([i] * 5)) for i in range(6)], "id int, content binary")

    def by_hash(c):
        return F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.ascii(F.substring(F.hex(c), i, F.lit(1))).cast("double"))

    with pytest.warns(UserWarning, match="no topics"):
        m = dataset.map_data(spark, root, "i", rows, blobs=blobs, id_field="id", **{**FAST, "embedder": by_hash, "topic_model": None})
    assert m.latent.count() == m.dataset.blobs.count() == 6
    # the embedder sees the bytes: 03 03 ... in hex
    assert m.latent.filter("id = 3").first()["vector"] == [float(ord(c)) for c in "0303"]
    with pytest.raises(ValueError, match="without topics"):
        m.topics


def test_options():
    assert options.read(None, options.TopicOptions).build_topic_model
    assert not options.read(False, options.TopicOptions, "build_topic_model").build_topic_model
    assert options.read({"duplicate_cutoff": 0.2}, options.DuplicateOptions).duplicate_cutoff == 0.2
    with pytest.raises(TypeError):
        options.read({"topic_label_feild": "x"}, options.TopicOptions)
    with pytest.raises(TypeError):
        options.read(3, options.TopicOptions)


def test_two_writers(spark, root):
    one = dataset.Dataset.create(spark, root, "d", modality="text", id_field="id")
    other = dataset.Dataset(spark, root, "d")
    began = other._entries()[-1].seq
    one.add_data(table(spark))
    with pytest.raises(RuntimeError):  # worked out before those rows came
        other._log("load", {"path": "x", "ids": None}, began)
    assert other.total_datums == 8 and [e.seq for e in other._entries()] == list(range(len(one._entries())))
    stale = other._entries()
    one._log("note", {})
    other._entries = lambda: stale
    with pytest.raises(Exception, match="(?i)exist"):
        other._log("note", {})
