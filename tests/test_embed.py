import hashlib
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmap.operators import embed
from corpusmap.sources import records, sinks

DIMS = 32


def one(words):
    v = np.zeros(DIMS)
    for w in set(words):
        h = int(hashlib.md5(w.encode()).hexdigest()[:8], 16)
        v[h % DIMS] += (1 + math.log(words.count(w))) * (1 if (h // DIMS) % 2 == 0 else -1)
    n = np.linalg.norm(v)
    return v / n if n else v


def by_hand(text, chunk=None, most=None, task="search_document"):
    words = re.findall(r"[^\W\d_]+", f"{task}: {text}".lower())[:most]
    if chunk is None:
        return one(words)
    parts = [one(words[i : i + chunk]) for i in range(0, len(words), chunk)]
    m = np.mean(parts, axis=0)
    return m / np.linalg.norm(m)


TEXTS = ["a b b c", "Été à la plage, la la", "x " * 50 + "y", "12 34", ""]


def vectors_of(df):
    return [np.array(r["_embeddings"]) for r in df.orderBy("id").collect()]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def test_hashing(texts):
    got = vectors_of(embed.embed_text(texts, embedder=embed.hash_embedder(DIMS)))
    for text, v in zip(TEXTS, got):
        assert np.allclose(v, by_hand(text or embed.EMPTY_TEXT))


@pytest.mark.parametrize("mode", ["truncate", "mean"])
def test_long_texts(texts, mode):
    made = embed.hash_embedder(DIMS, long_text_mode=mode, max_tokens=4)
    got = vectors_of(embed.embed_text(texts, embedder=made, task_type="clustering"))
    for text, v in zip(TEXTS, got):
        want = by_hand(
            text or embed.EMPTY_TEXT, 4 if mode == "mean" else None, 4 if mode == "truncate" else None, "clustering"
        )
        assert np.allclose(v, want)


def test_fewer_dimensions(texts):
    got = vectors_of(embed.embed_text(texts, embedder=embed.hash_embedder(DIMS), dims=8))
    full = by_hand(TEXTS[0])[:8]
    assert np.allclose(got[0], full / np.linalg.norm(full))


def test_no_texts(spark, texts):
    assert embed.embed_text(texts.filter("false"), embedder=embed.hash_embedder(DIMS)).count() == 0


def test_bad_arguments(texts):
    with pytest.raises(ValueError):
        embed.embed_text(texts, task_type="poetry")
    with pytest.raises(ValueError):
        embed.hash_embedder(long_text_mode="skip")
    with pytest.raises(TypeError):
        embed.embed_text("one text")


def test_own_embedder(texts):
    @F.pandas_udf("array<double>")
    def lengths(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [float(len(t)), 1.0])

    got = vectors_of(embed.embed_text(texts, embedder=lengths))
    assert got[0].tolist() == [len("search_document: a b b c"), 1.0]


def test_chunks_cover_the_text(texts):
    chunks = embed.char_chunks(texts, "text", 7).orderBy("id", "chunk").collect()
    joined = {}
    for r in chunks:
        joined[r.id] = joined.get(r.id, "") + r.text
    assert [joined[i] for i in range(len(TEXTS))] == TEXTS


def test_pooling(spark):
    df = spark.createDataFrame([(1, [3.0, 0.0]), (1, [0.0, 2.0]), (2, [0.0, 5.0])], "id int, v array<double>")
    got = {r.id: r.v for r in embed.pool_chunks(df, "id", "v").collect()}
    assert np.allclose(got[1], [math.sqrt(0.5)] * 2) and np.allclose(got[2], [0, 1])


def test_reuse_only_unchanged(spark):
    old = spark.createDataFrame([(1, "a", [1.0]), (2, "b", [2.0])], "id int, text string, vector array<double>")
    stored = old.select("id", embed.text_hash(F.col("text")).alias("text_hash"), "vector")
    now = spark.createDataFrame([(1, "a"), (2, "changed"), (3, "new")], "id int, text string")
    kept, fresh = embed.reuse_split(now, stored, "id", "text")
    assert [r.id for r in kept.collect()] == [1] and sorted(r.id for r in fresh.collect()) == [2, 3]


@pytest.mark.parametrize("first, dims", [("8, False", 8), ("8, True", 8), (None, DIMS)])
def test_line_file_keeps_order(spark, tmp_path, first, dims):
    lines = [f"line number {'z' * (i % 7)} {i}" for i in range(200)]
    path = tmp_path / "in.txt"
    path.write_text("\n".join(([first] if first else []) + lines) + "\n")
    out = str(tmp_path / "out")
    sinks.write_lines(embed.embed_lines(records.text_lines(spark, str(path)), embed.hash_embedder(DIMS)), out)
    got = spark.read.json(out).orderBy("ordinal").collect()
    assert [r.text for r in got] == lines
    assert {len(r.embedding) for r in got} == {dims}
    if first and "True" in first:
        assert {x for r in got for x in r.embedding} <= {0.0, 1.0}


def test_image_sources(spark):
    df = spark.createDataFrame([("http://a/b.png",), ("HTTPS://a",), ("/x/y.png",), ("http://",)], "u string")
    assert [r[0] for r in df.select(embed.image_source(F.col("u"))).collect()] == ["url", "url", "file", "file"]


def test_images_of_one_kind(spark):
    df = spark.createDataFrame([("http://a/b.png",), ("/x/y.png",)], "u string")

    def size(c):
        return F.array(F.length(c).cast("double"))

    assert embed.embed_images(df.filter("u LIKE '/%'"), "u", size).first()["_embeddings"] == [8.0]
    with pytest.raises(ValueError, match="not both"):
        embed.embed_images(df, "u", size)


def test_shards_hold_few_rows(spark, tmp_path):
    out = str(tmp_path / "shards")
    sinks.append_shards(spark.range(0, 25, 1, 1), out, rows=10)
    sinks.append_shards(spark.range(25, 30, 1, 1), out, rows=10)
    files = spark.read.parquet(out).groupBy(F.input_file_name()).count().collect()
    assert sorted(r["count"] for r in files) == [5, 5, 10, 10]


def test_whole_text_counts(spark):
    """The end of a text of 20,000 tokens changes its vector."""
    start = "alpha beta " * 10_000
    df = spark.createDataFrame([(0, start + "omega " * 500), (1, start)], "id int, text string")
    a, b = vectors_of(embed.embed_text(df, embedder=embed.hash_embedder(DIMS)))
    assert not np.allclose(a, b)
    a, b = vectors_of(embed.embed_text(df, embedder=embed.hash_embedder(DIMS, max_tokens=8192)))
    assert np.allclose(a, b)


def test_memory_does_not_grow_with_the_tokens_of_a_batch():
    import tracemalloc

    tokens = np.random.default_rng(2).integers(0, 1 << 32, 2_000_000)
    rows = pa.ListArray.from_arrays(pa.array(np.arange(0, len(tokens) + 1, 5000), pa.int32()), pa.array(tokens))
    tracemalloc.start()
    try:
        found = embed._hashed(rows, 64, 128)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 48 << 20, peak
    whole = embed._hash_rows(rows, 64, 128)
    assert np.array_equal(np.asarray(found.flatten()).reshape(-1, 64), whole)
