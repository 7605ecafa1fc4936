"""Queries over vectors: search, graphs, posteriors and vector functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmap.functions import vectors
from corpusmap.operators import knn
from corpusmap.sources.tables import table

GRAPH_K = 5
# Rows of a cell, few, so that tables of any scale have cells of both levels.
CELL_ROWS = 16


def _points(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"
    )


def _chosen(points: DataFrame) -> DataFrame:
    """The queries of a search request: the first row of every label."""
    first = F.min_by(F.struct("id", "vector"), "id")
    return points.groupBy("label").agg(first.alias("first")).select("first.*")


def _rounded(found: DataFrame) -> DataFrame:
    return found.withColumn("distance", F.round("distance", 4))


def knn_by_vector(spark, folder):
    p = _points(spark, folder)
    return _rounded(knn.search_by_vector(p, _chosen(p), 5))


def knn_by_id(spark, folder):
    p = _points(spark, folder)
    found = _rounded(knn.search_by_id(p, _chosen(p), 5, metric="cosine", include_self=False))
    return knn.neighbor_rows(found, p.select("id", "label"))


def knn_ivf(spark, folder):
    p = _points(spark, folder)
    return _rounded(knn.join_nearest(p, p, 10, cell_rows=CELL_ROWS))


def knn_graph(spark, folder):
    return _rounded(knn.neighbor_graph(_points(spark, folder), GRAPH_K, metric="cosine", cell_rows=CELL_ROWS))


def neighbor_rows(spark, folder):
    p = _points(spark, folder)
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    found = knn.search_by_vector(p, _chosen(p), 4).drop("distance")
    return knn.neighbor_rows(found, docs)


def topic_posterior(spark, folder):
    p = _points(spark, folder)
    found = knn.search_by_vector(p, _chosen(p), 32)
    return knn.topic_posterior(found, p, "id", "label").withColumn(
        "probability", F.round("probability", 6)
    )


def predict_topic(spark, folder):
    p = _points(spark, folder)
    found = knn.search_by_vector(p, _chosen(p), 32)
    best = knn.most_likely_topic(knn.topic_posterior(found, p, "id", "label"))
    return best.withColumn("probability", F.round("probability", 6))


def place_new_points(spark, folder):
    p = _points(spark, folder)
    known, new = p.filter("label < 7"), p.filter("label >= 7")
    where = known.select("id", F.col("vector")[0].cast("double").alias("x"), F.col("vector")[1].cast("double").alias("y"))
    placed = knn.place_new_points(knn.join_nearest(new, known, 15, cell_rows=CELL_ROWS), where)
    return placed.select("id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def similarity_filter(spark, folder):
    p = _points(spark, folder)
    query = p.orderBy("id").first()["vector"]
    kept = knn.similar_rows(p, query, 0.1)
    return kept.select("id", "label", F.round("similarity", 4).alias("similarity"))


def truncate_dims(spark, folder):
    return _points(spark, folder).select(
        "id", vectors.vector_key(vectors.truncate_dims(F.col("vector"), 16)).alias("vector")
    )


def binarize(spark, folder):
    p = _points(spark, folder)
    first = F.array(*[F.lit(x > 0) for x in p.orderBy("id").first()["vector"]])
    bits = vectors.binarize(F.col("vector"))
    text = F.array_join(F.transform(bits, lambda b: F.when(b, "1").otherwise("0")), "")
    return p.select(
        "id", text.alias("bits"), vectors.hamming_distance(bits, first).cast("bigint").alias("hamming")
    )


def quantize_f16(spark, folder):
    p = _points(spark, folder)
    scaled = F.transform("vector", lambda x: x * F.lit(200000.0).cast("float"))
    half = vectors.quantize_half(scaled)
    text = F.transform(half, lambda x: F.when(F.abs(x) < 1e30, x.cast("bigint").cast("string")).otherwise("inf"))
    return p.select("id", F.array_join(text, ",").alias("half"), vectors.overflows_half(scaled).alias("overflows"))


def latent_vectors(spark, folder):
    return _points(spark, folder).select("id", vectors.vector_key(F.col("vector"), 5).alias("vector"))


QUERIES = {
    f.__name__: f
    for f in (
        knn_by_vector, knn_by_id, knn_ivf, knn_graph, neighbor_rows, topic_posterior, predict_topic,
        place_new_points, similarity_filter, truncate_dims, binarize, quantize_f16, latent_vectors,
    )
}

_P = "p AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings)"
_CHOSEN = "q AS (SELECT * FROM p WHERE id IN (SELECT min(id) FROM p GROUP BY label))"


def _nearest(k: int, distance: str, queries: str = "q", corpus: str = "p", where: str = "true") -> str:
    return f"""n AS (SELECT query_id, neighbor_id, distance, rank FROM (
      SELECT q.id AS query_id, p.id AS neighbor_id, {distance} AS distance,
             row_number() OVER (PARTITION BY q.id ORDER BY {distance}, p.id) AS rank
      FROM {queries} q, {corpus} p WHERE {where}) WHERE rank <= {k})"""


def _plain(number: str) -> str:
    """A rounded number without a negative zero."""
    return f"CASE WHEN {number} = 0 THEN 0.0::DOUBLE ELSE {number} END"


_L2 = "list_distance(q.v, p.v)"
_COS = "(1 - list_cosine_similarity(q.v, p.v))"
_FOUND = "query_id, neighbor_id, abs(round(distance, 4)) AS distance, rank::INTEGER AS rank"
_KEY = "list_aggregate(list_transform({v}, lambda x: round(x * 1e4)::BIGINT::VARCHAR), 'string_agg', ',')"

ORACLES = {
    "knn_by_vector": f"WITH {_P}, {_CHOSEN}, {_nearest(5, _L2)} SELECT {_FOUND} FROM n",
    "knn_by_id": f"""WITH {_P}, {_CHOSEN}, {_nearest(5, _COS, where="q.id <> p.id")}
      SELECT {_FOUND}, label FROM n JOIN p ON p.id = n.neighbor_id""",
    "knn_ivf": f"""WITH {_P}, {_nearest(10, _L2, 'p')} SELECT {_FOUND} FROM n""",
    "knn_graph": f"WITH {_P}, {_nearest(GRAPH_K, _COS, 'p', 'p', 'q.id <> p.id')} SELECT {_FOUND} FROM n",
    "neighbor_rows": f"""WITH {_P}, {_CHOSEN}, {_nearest(4, _L2)}
      SELECT query_id, neighbor_id, rank::INTEGER AS rank, lang, source
      FROM n JOIN documents d ON d.doc_id = n.neighbor_id""",
    "topic_posterior": f"""WITH {_P}, {_CHOSEN}, {_nearest(32, _L2)}
      SELECT query_id, label AS topic, round(count(*) / 32.0, 6)::DOUBLE AS probability
      FROM n JOIN p ON p.id = n.neighbor_id GROUP BY ALL""",
    "predict_topic": f"""WITH {_P}, {_CHOSEN}, {_nearest(32, _L2)},
      t AS (SELECT query_id, label AS topic, count(*) / 32.0 AS pr
            FROM n JOIN p ON p.id = n.neighbor_id GROUP BY query_id, label)
      SELECT query_id, topic, round(pr, 6)::DOUBLE AS probability FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY pr DESC, topic) AS r FROM t) WHERE r = 1""",
    "place_new_points": f"""WITH {_P}, {_nearest(15, _L2, "(SELECT * FROM p WHERE label >= 7)", "(SELECT * FROM p WHERE label < 7)")}
      SELECT query_id AS id, {_plain("round(avg(p.v[1]), 4)")} AS x, {_plain("round(avg(p.v[2]), 4)")} AS y
      FROM n JOIN p ON p.id = n.neighbor_id GROUP BY query_id""",
    "similarity_filter": f"""WITH {_P} SELECT p.id, p.label, round(list_inner_product(p.v, q.v), 4) AS similarity
      FROM p, (SELECT v FROM p WHERE id = (SELECT min(id) FROM p)) q WHERE list_inner_product(p.v, q.v) > 0.1""",
    "truncate_dims": f"""WITH {_P}, t AS (SELECT id, v[1:16] AS w FROM p)
      SELECT id, {_KEY.format(v="list_transform(w, lambda y: y / sqrt(list_inner_product(w, w)))")} AS vector FROM t""",
    "binarize": f"""WITH {_P},
      b AS (SELECT id, list_aggregate(list_transform(v, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), 'string_agg', '') AS bits FROM p)
      SELECT b.id, b.bits, hamming(b.bits, z.bits)::BIGINT AS hamming FROM b, (SELECT bits FROM b WHERE id = 0) z""",
    "quantize_f16": """WITH s AS (SELECT vec_id AS id, list_transform(embedding, lambda x: (x * 200000.0::FLOAT)::DOUBLE) AS v FROM embeddings),
      q AS (SELECT id, v, list_transform(v, lambda x: pow(2.0, greatest(floor(log2(abs(x) + CASE WHEN x = 0 THEN 1 ELSE 0 END)), -14) - 10)) AS steps FROM s)
      SELECT id, list_aggregate(list_transform(list_zip(v, steps), lambda z: CASE WHEN abs(z[1]) >= 65520 THEN 'inf'
        ELSE trunc(round_even(z[1] / z[2], 0) * z[2])::BIGINT::VARCHAR END), 'string_agg', ',') AS half,
      len(list_filter(v, lambda x: abs(x) >= 65520)) > 0 AS overflows FROM q""",
    "latent_vectors": f"""WITH {_P} SELECT id, {_KEY.format(v="v").replace("1e4", "1e5")} AS vector FROM p""",
}
