"""Queries over topics, 2-D layout and tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmap.functions import text
from corpusmap.operators import projection, tiles, topics
from corpusmap.sources.tables import table

TILE_ROWS = 64
LASSO = [(-0.2, -0.1), (0.05, -0.25), (0.2, 0.0), (0.1, 0.15), (0.0, 0.02), (-0.15, 0.12)]
WINDOW = ("2024-01-05 00:00:00", "2024-01-12 23:59:59")
LATER = ("2024-01-13 00:00:00", "2024-01-20 23:59:59")


def topic_rows(events):
    """Events with a topic path: their type, then a quarter of ``props.k``; small k has no topic."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.when(k >= 5, F.col("event_type"))
    part = F.concat_ws("-", "event_type", F.floor(k / 25).cast("string"))
    return events.select(
        F.col("event_id").alias("id"), "ts", kind.alias("topic_depth_1"), F.when(k >= 15, part).alias("topic_depth_2")
    )


def _rows(spark, folder):
    return topic_rows(table(spark, folder, "events"))


def _code(c):
    return text.token_hash(c)


def stored_metadata(rows):
    """Stored topic rows of the paths that occur; topic numbers come from the labels."""
    one, two = F.col("topic_depth_1"), F.col("topic_depth_2")
    none = F.lit(None).cast("string")
    first = rows.filter(one.isNotNull()).select(
        _code(one).alias("topic"), F.lit(1).alias("depth"), one.alias("topic_short_description"),
        F.concat(F.lit("all of "), one).alias("topic_description"), one.alias("_topic_depth_1"), none.alias("_topic_depth_2"),
    )
    second = rows.filter(two.isNotNull()).select(
        _code(two).alias("topic"), F.lit(2).alias("depth"), two.alias("topic_short_description"),
        F.concat(F.lit("part "), two).alias("topic_description"), one.alias("_topic_depth_1"), two.alias("_topic_depth_2"),
    )
    return first.unionByName(second).distinct()


def coded(rows):
    """Topic numbers per row; errors carry a number that no label has."""
    one, two = F.col("topic_depth_1"), F.col("topic_depth_2")
    return rows.select(
        "id", F.when(one == "error", F.lit(-1)).otherwise(_code(one)).alias("topic_depth_1"), _code(two).alias("topic_depth_2")
    )


def topic_table(spark, folder):
    return topics.metadata(stored_metadata(_rows(spark, folder)))


def label_topics(spark, folder):
    rows = _rows(spark, folder)
    return topics.label_topics(coded(rows), topics.metadata(stored_metadata(rows)))


def topic_hierarchy(spark, folder):
    return topics.hierarchy(topics.metadata(stored_metadata(_rows(spark, folder))))


def group_by_topic(spark, folder):
    rows = _rows(spark, folder)
    grouped = topics.group_by_topic(rows, topics.metadata(stored_metadata(rows)), 1)
    return grouped.withColumns(
        {
            "subtopics": F.array_join("subtopics", ","),
            "subtopic_ids": F.array_join(F.col("subtopic_ids").cast("array<string>"), ","),
        }
    )


def topic_members(spark, folder):
    return topics.topic_members(_rows(spark, folder), 2)


def topic_density(spark, folder):
    return topics.topic_density(_rows(spark, folder), "ts", *WINDOW)


def topic_density_collapsed(spark, folder):
    return topics.topic_density(_rows(spark, folder), "ts", *WINDOW, collapse=True)


def topic_trend(spark, folder):
    return topics.topic_trend(_rows(spark, folder), "ts", WINDOW, LATER)


def topic_filter(spark, folder):
    return topics.in_topic(_rows(spark, folder), "click-2", 2).select("id", "topic_depth_1")


def topic_keywords(spark, folder):
    docs = table(spark, folder, "documents")
    found = topics.topic_keywords(docs, "source", "text")
    return found.groupBy("topic").agg(
        F.expr("listagg(word, '/') WITHIN GROUP (ORDER BY rank)").alias("topic_description")
    )


def _points(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def topic_model(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    assigned, meta = topics.build_topics(_points(spark, folder), docs, (4, 12), enforce_hierarchy=True)
    return topics.label_topics(assigned, topics.metadata(meta))


def topic_model_flat(spark, folder):
    return topics.fit_topics(_points(spark, folder), (4, 12))


def projection_2d(spark, folder):
    return projection.project(_points(spark, folder))


def _plane(spark, folder):
    v = F.col("embedding").cast("array<double>")
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), v[0].alias("x"), v[1].alias("y"))


def quadtree_tiles(spark, folder):
    return tiles.quadtree(_plane(spark, folder), TILE_ROWS).select("id", "level", "tile")


def tile_manifest(spark, folder):
    found = tiles.manifest(tiles.quadtree(_plane(spark, folder), TILE_ROWS))
    return found.select("level", "tile", "n", *[F.round(c, 6).alias(c) for c in ("min_x", "max_x", "min_y", "max_y")])


def region_select(spark, folder):
    return tiles.select_region(_plane(spark, folder), LASSO).select("id")


QUERIES = {
    f.__name__: f
    for f in (
        topic_table, label_topics, topic_hierarchy, group_by_topic, topic_members, topic_density,
        topic_density_collapsed, topic_trend, topic_filter, topic_keywords, topic_model, topic_model_flat,
        projection_2d, quadtree_tiles, tile_manifest, region_select,
    )
}


def _code_sql(c: str) -> str:
    return f"('0x' || substr(md5({c}), 1, 8))::BIGINT"


ROWS_SQL = """k AS (SELECT event_id, ts, event_type, (props->>'$.k')::INTEGER AS k FROM events),
  r AS (SELECT event_id AS id, ts, CASE WHEN k >= 5 THEN event_type END AS t1,
    CASE WHEN k >= 15 THEN event_type || '-' || (k // 25) END AS t2 FROM k)"""
_META = f"""{ROWS_SQL},
  meta AS (SELECT DISTINCT {_code_sql("t1")} AS topic_id, 1 AS depth, t1 AS topic_short_description,
      'all of ' || t1 AS topic_description, t1 AS topic_depth_1, NULL::VARCHAR AS topic_depth_2 FROM r WHERE t1 IS NOT NULL
    UNION ALL SELECT DISTINCT {_code_sql("t2")}, 2, t2, 'part ' || t2, t1, t2 FROM r WHERE t2 IS NOT NULL)"""
_BY_DEPTH = "(SELECT ts, 1 AS depth, t1 AS topic FROM r UNION ALL SELECT ts, 2, t2 FROM r)"


def _in(window: tuple[str, str]) -> str:
    return f"ts BETWEEN TIMESTAMP '{window[0]}' AND TIMESTAMP '{window[1]}'"


def _tiles_sql(levels: int = 14) -> str:
    """Tiles by repeated ranking, one step per level; enough levels for the fixture."""
    share = "least(floor(({c} - lo_{c}) / (hi_{c} - lo_{c}) * {side})::BIGINT, {side} - 1)"
    parts = [
        """p AS (SELECT vec_id AS id, (embedding::DOUBLE[])[1] AS x, (embedding::DOUBLE[])[2] AS y FROM embeddings),
        b AS (SELECT min(x) AS lo_x, max(x) AS hi_x, min(y) AS lo_y, max(y) AS hi_y FROM p),
        l0 AS (SELECT p.*, b.* FROM p, b)"""
    ]
    for z in range(levels):
        cx, cy = (share.format(c=c, side=2**z) for c in "xy")
        parts.append(
            f"""k{z} AS (SELECT *, '{z}/' || {cx} || '/' || {cy} AS tile,
              row_number() OVER (PARTITION BY {cx}, {cy} ORDER BY md5('0:' || id::VARCHAR), id) AS n FROM l{z}),
            l{z + 1} AS (SELECT * EXCLUDE (tile, n) FROM k{z} WHERE n > {TILE_ROWS})"""
        )
    union = " UNION ALL ".join(f"SELECT id, x, y, {z} AS level, tile FROM k{z} WHERE n <= {TILE_ROWS}" for z in range(levels))
    return f"WITH {', '.join(parts)}, tiled AS ({union})"


def _bound(number: str) -> str:
    """Rounded, and without a negative zero."""
    return f"CASE WHEN round({number}, 6) = 0 THEN 0.0::DOUBLE ELSE round({number}, 6) END"


def _lasso_sql() -> str:
    sums = [
        f"(({y1} > y) <> ({y2} > y) AND x < ({x2} - ({x1}))::DOUBLE * (y - ({y1})) / (({y2}) - ({y1}))::DOUBLE + ({x1}))::INTEGER"
        for (x1, y1), (x2, y2) in zip(LASSO, [*LASSO[1:], LASSO[0]])
    ]
    return " + ".join(sums)


ORACLES = {
    "topic_table": f"WITH {_META} SELECT * FROM meta",
    "label_topics": f"""WITH {ROWS_SQL} SELECT id, CASE WHEN t1 <> 'error' THEN t1 END AS topic_depth_1, t2 AS topic_depth_2 FROM r""",
    "topic_hierarchy": f"""WITH {_META} SELECT DISTINCT topic_depth_1 AS topic, 1 AS depth, topic_depth_2 AS subtopic
      FROM meta WHERE topic_depth_2 IS NOT NULL""",
    "group_by_topic": f"""WITH {_META},
      n AS (SELECT t1, count(*) AS n FROM r WHERE t1 IS NOT NULL GROUP BY t1),
      s AS (SELECT topic_depth_1, string_agg(topic_short_description, ',' ORDER BY topic_short_description) AS subtopics,
        string_agg(topic_id::VARCHAR, ',' ORDER BY topic_short_description) AS subtopic_ids FROM meta WHERE depth = 2 GROUP BY 1)
      SELECT topic_short_description, n, topic_id, topic_description AS topic_long_description, subtopics, subtopic_ids
      FROM n JOIN meta ON topic_short_description = t1 AND depth = 1 LEFT JOIN s ON s.topic_depth_1 = t1""",
    "topic_members": f"WITH {ROWS_SQL} SELECT t2 AS topic, id FROM r WHERE t2 IS NOT NULL",
    "topic_density": f"""WITH {ROWS_SQL} SELECT depth, topic, count(*) AS n FROM {_BY_DEPTH} WHERE {_in(WINDOW)} GROUP BY ALL""",
    "topic_density_collapsed": f"""WITH {ROWS_SQL} SELECT topic, count(*) AS n FROM {_BY_DEPTH} WHERE {_in(WINDOW)} GROUP BY ALL""",
    "topic_trend": f"""WITH {ROWS_SQL} SELECT depth, topic, count(*) FILTER ({_in(WINDOW)}) AS n_earlier,
      count(*) FILTER ({_in(LATER)}) AS n_later, count(*) FILTER ({_in(LATER)}) - count(*) FILTER ({_in(WINDOW)}) AS change
      FROM {_BY_DEPTH} WHERE {_in(WINDOW)} OR {_in(LATER)} GROUP BY depth, topic""",
    "topic_filter": f"WITH {ROWS_SQL} SELECT id, t1 AS topic_depth_1 FROM r WHERE t2 = 'click-2'",
    "topic_keywords": rf"""WITH w AS (SELECT DISTINCT doc_id, source AS topic,
        unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM documents),
      c AS (SELECT topic, word, count(*) AS n FROM w GROUP BY ALL),
      t AS (SELECT word, sum(n) AS total FROM c GROUP BY word),
      s AS (SELECT topic, word, round(n * ln(1 + (SELECT sum(n) / count(DISTINCT topic) FROM c) / total), 9) AS score
        FROM c JOIN t USING (word) WHERE total <= 0.5 * (SELECT count(*) FROM documents)),
      k AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, word) AS rank FROM s)
      SELECT topic, string_agg(word, '/' ORDER BY rank) AS topic_description FROM k WHERE rank <= 15 GROUP BY topic""",
    "quadtree_tiles": f"{_tiles_sql()} SELECT id, level, tile FROM tiled",
    "tile_manifest": f"""{_tiles_sql()} SELECT level, tile, count(*) AS n, {_bound("min(x)")} AS min_x, {_bound("max(x)")} AS max_x,
      {_bound("min(y)")} AS min_y, {_bound("max(y)")} AS max_y FROM tiled GROUP BY level, tile""",
    "region_select": f"""WITH p AS (SELECT vec_id AS id, (embedding::DOUBLE[])[1] AS x, (embedding::DOUBLE[])[2] AS y FROM embeddings)
      SELECT id FROM p WHERE ({_lasso_sql()}) % 2 = 1""",
}
