import random

import pytest
from pyspark.sql import functions as F

from corpusmap.operators import embed, tag_blocks
from corpusmap.plans import dataset
from corpusmap.session import scratch_path


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("rows", [tag_blocks.BLOCK_ROWS, 40])
def test_stores_against_sets(spark, rows):
    draw = random.Random(5)
    tiled = [(i, 0 if i % 9 else 1, "0/0/0" if i % 9 else "1/0/1") for i in range(700)]  # one tile holds most
    held = {(i, t) for i in range(700) for t, p in (("often", 0.9), ("seldom", 0.01), ("half", 0.5)) if draw.random() < p}
    held |= {(i, "all") for i in range(700)}
    gone = {(i, t) for i, t in held if draw.random() < 0.3} | {(3, "never"), (5, "all")}
    more = {(i, "half") for i in range(0, 700, 2)} | {(i, "new") for i in range(10)}
    seats = tag_blocks.seat_rows(spark.createDataFrame(tiled, "id int, level int, tile string"), rows).persist()
    blocks = tag_blocks.blocks_of(seats)
    assert seats.select("block", "seat").distinct().count() == 700 and (blocks.count() > 12) == (rows == 40)

    def store(of):
        return tag_blocks.stored(seats, blocks, spark.createDataFrame([*of, *list(of)[:5], (9999, "all"), (1, None)], "id int, tag string"))

    first = store(held)
    assert first.filter("tag = 'all' and bits is not null").count() == 0
    assert pairs(tag_blocks.tagged_rows(seats, first)) == sorted(held)
    assert pairs(tag_blocks.tagged_rows(seats, tag_blocks.with_tags(first, store(more), blocks))) == sorted(held | more)
    left = tag_blocks.without_tags(first, store(gone), blocks)
    assert pairs(tag_blocks.tagged_rows(seats, left)) == sorted(held - gone)
    assert pairs(tag_blocks.tag_sizes(left)) == sorted((t, sum(u == t for _, u in held - gone)) for t in {t for _, t in held - gone})
    # what is whole again has no bits again
    again = tag_blocks.with_tags(left, store({(i, "all") for i in range(700)}), blocks)
    assert again.filter("tag = 'all' and bits is not null").count() == 0
    assert tag_blocks.without_tags(first, first, blocks).count() == 0
    seats.unpersist()


def test_more_rows_than_a_bitmap_holds(spark):
    tiled = spark.range(70_000).select("id", F.lit(0).alias("level"), F.lit("0/0/0").alias("tile"))
    for rows in (tag_blocks.BLOCK_ROWS, 10**9):  # dealt by hash, then by numbers of bitmaps alone
        seats = tag_blocks.seat_rows(tiled, rows).persist()
        blocks = tag_blocks.blocks_of(seats)
        assert blocks.agg(F.max("size")).first()[0] <= 32_768
        store = tag_blocks.stored(seats, blocks, tiled.select("id", F.when(F.col("id") > 60_000, "late").otherwise("early").alias("tag")))
        found = tag_blocks.tagged_rows(seats, store).groupBy("tag").agg(F.min("id"), F.max("id"), F.count("id"))
        assert pairs(found) == [("early", 0, 60_000, 60_001), ("late", 60_001, 69_999, 9_999)]
        seats.unpersist()


def test_empty_tables(spark):
    seats = tag_blocks.seat_rows(spark.createDataFrame([], "id int, level int, tile string"))
    blocks = tag_blocks.blocks_of(seats)
    store = tag_blocks.stored(seats, blocks, spark.createDataFrame([(1, "a")], "id int, tag string"))
    assert store.count() == tag_blocks.with_tags(store, store, blocks).count() == tag_blocks.without_tags(store, store, blocks).count() == 0
    assert tag_blocks.tagged_rows(seats, store).count() == 0


def test_incomplete_tags_of_a_map_stay_hidden(spark):
    rows = spark.createDataFrame([(i, f"word{i} apple") for i in range(40)], "key int, body string")
    m = dataset.map_data(
        spark, scratch_path(spark, "maps"), "d", rows, indexed_field="body", id_field="key", tile_rows=8, topic_model=False,
        duplicate_detection=False, projection_options={"n_epochs": 1, "n_neighbors": 3}, embedder=embed.hash_embedder(8),
    )
    ids = rows.select(F.col("key").alias("id"))
    levels = sorted(r.level for r in m.tiles.select("level").distinct().collect())
    assert len(levels) > 1
    m.add_tags(ids.filter("id < 10"), ["slow"], levels=levels[:1])
    m.add_tags(ids.filter("id < 3"), ["quick", "a"])
    assert pairs(m.tag_definitions) == [("a", True), ("quick", True), ("slow", False)]
    assert m.tag_table().columns == ["id", "a", "quick"] and pairs(m.tag_counts) == [("a", 3), ("quick", 3)]
    with pytest.raises(ValueError):
        m.rows_in_tag("slow")
    m.add_tags(ids.filter("id < 10"), ["slow"], levels=levels[1:])
    assert pairs(m.rows_in_tag("slow")) == [(i,) for i in range(10)]
    m.remove_tags(ids.filter("id > 1"), ["slow"])
    m.remove_tags(None, ["a"], delete_all=True)
    lists = {r.id: r.tags for r in m.tag_lists().collect()}
    assert lists[0] == lists[1] == ["quick", "slow"] and lists[2] == ["quick"] and lists[3] == [] and len(lists) == 40
