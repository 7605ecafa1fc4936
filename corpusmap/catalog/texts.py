"""Queries over text embedding, chunking and semantic duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmap.functions import vectors
from corpusmap.operators import duplicates, embed
from corpusmap.session import scratch_path
from corpusmap.sources import records, sinks
from corpusmap.sources.tables import table

DIMS = 64
CHUNK_TOKENS = 128
CHUNK_CHARS = 500
DUPLICATE_DIMS = 256


def _docs(spark, folder):
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")


def _keyed(df, *keep):
    return df.select("id", *keep, vectors.vector_key(F.col("_embeddings")).alias("vector"))


def embed_text(spark, folder):
    # French texts stand for empty ones.
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.when(F.col("lang") == "fr", "").otherwise(F.col("text")).alias("text")
    )
    return _keyed(embed.embed_text(docs, embedder=embed.hash_embedder(DIMS)))


def embed_long_text(spark, folder):
    by_mean = embed.hash_embedder(DIMS, long_text_mode="mean", max_tokens=CHUNK_TOKENS)
    return _keyed(embed.embed_text(_docs(spark, folder), embedder=by_mean, task_type="clustering"))


def char_chunks(spark, folder):
    chunks = embed.char_chunks(_docs(spark, folder), "text", CHUNK_CHARS)
    return chunks.select("id", "chunk", F.md5("text").alias("text_md5"))


def pool_chunks(spark, folder):
    chunks = embed.char_chunks(_docs(spark, folder), "text", CHUNK_CHARS)
    embedded = embed.embed_text(chunks, embedder=embed.hash_embedder(DIMS))
    return _keyed(embed.pool_chunks(embedded, "id", "_embeddings"))


def reuse_embeddings(spark, folder):
    # Labelled documents were embedded before; those of low quality have changed since.
    docs = _docs(spark, folder)
    labels = table(spark, folder, "labels").withColumnRenamed("doc_id", "id")
    before = docs.join(labels, "id").withColumn(
        "text", F.when(F.col("quality") == 0, F.concat(F.lit("old "), "text")).otherwise(F.col("text"))
    )
    stored = before.select("id", embed.text_hash(F.col("text")).alias("text_hash"))
    kept, fresh = embed.reuse_split(docs, stored, "id", "text")
    return kept.select("id", F.lit("kept").alias("vector_from")).unionByName(
        fresh.select("id", F.lit("embedded").alias("vector_from"))
    )


def batch_embed_file(spark, folder):
    texts = table(spark, folder, "benchmark").select(F.regexp_replace("text", r"[\r\n]+", " ").alias("value"))
    path, out = scratch_path(spark, "lines"), scratch_path(spark, "embedded")
    texts.write.text(path)
    lines = records.text_lines(spark, path)
    sinks.write_lines(embed.embed_lines(lines, embed.hash_embedder(DIMS)), out)
    return spark.read.schema("text string, embedding array<double>").json(out).select(
        F.md5("text").alias("text_md5"), vectors.vector_key(F.col("embedding")).alias("vector")
    )


def image_ref_kind(spark, folder):
    refs = table(spark, folder, "pages").select(
        "page_id", F.explode(F.array("url", F.regexp_replace("url", "^https?://", "/images/"))).alias("ref")
    )
    return refs.select("page_id", "ref", embed.image_source(F.col("ref")).alias("kind"))


def _duplicates(spark, folder):
    docs = embed.embed_text(_docs(spark, folder), embedder=embed.hash_embedder(DUPLICATE_DIMS), output="vector")
    path = scratch_path(spark, "vectors")
    sinks.write_version(docs.select("id", "vector"), path)
    return duplicates.find_duplicates(sinks.read_version(spark, path))


def semantic_duplicates(spark, folder):
    return _duplicates(spark, folder)


def deletion_candidates(spark, folder):
    return duplicates.deletion_candidates(_duplicates(spark, folder))


def dedup_dataset(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    return duplicates.deduplicated(docs, _duplicates(spark, folder))


def duplicate_summary(spark, folder):
    return duplicates.summary(_duplicates(spark, folder))


def largest_clusters(spark, folder):
    return duplicates.largest_clusters(_duplicates(spark, folder), 10)


QUERIES = {
    f.__name__: f
    for f in (
        embed_text, embed_long_text, char_chunks, pool_chunks, reuse_embeddings, batch_embed_file,
        image_ref_kind, semantic_duplicates, deletion_candidates, dedup_dataset, duplicate_summary,
        largest_clusters,
    )
}


def _unit(v: str) -> str:
    return f"list_transform({v}, lambda y: CASE WHEN list_inner_product({v}, {v}) > 0 THEN y / sqrt(list_inner_product({v}, {v})) ELSE 0 END)"


def _key(v: str) -> str:
    return f"list_aggregate(list_transform({v}, lambda z: round(z * 1e4)::BIGINT::VARCHAR), 'string_agg', ',')"


def hash_sql(units: str, dims: int) -> str:
    """SQL for unit-length feature-hashed vectors ``u, v`` of the token lists ``u, words``."""
    return f"""
      units AS ({units}),
      tok AS (SELECT u, ('0x' || substr(md5(t), 1, 8))::BIGINT AS h, count(*) AS tf
        FROM (SELECT u, unnest(words) AS t FROM units) GROUP BY u, h),
      buckets AS (SELECT u, h % {dims} AS pos, sum((1 + ln(tf)) * CASE WHEN (h // {dims}) % 2 = 0 THEN 1 ELSE -1 END) AS w
        FROM tok GROUP BY u, pos),
      dense AS (SELECT units.u, list(coalesce(w, 0.0)::DOUBLE ORDER BY r.pos) AS v
        FROM units CROSS JOIN (SELECT unnest(range({dims})) AS pos) r
        LEFT JOIN buckets b ON b.u = units.u AND b.pos = r.pos GROUP BY units.u),
      vecs AS (SELECT u, {_unit("v")} AS v FROM dense)"""


def _words(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '\p{{L}}+')"


def _mean_sql(dims: int) -> str:
    """Mean of the vectors of chunk units ``u = {id, chunk}`` as unit vectors ``id, m``."""
    return f"""parts AS (SELECT u.id AS id, unnest(v) AS x, unnest(range(1, {dims + 1})) AS pos FROM vecs),
      means AS (SELECT id, list(x ORDER BY pos) AS m FROM (SELECT id, pos, avg(x) AS x FROM parts GROUP BY id, pos) GROUP BY id)"""


_DOC_VECS = hash_sql(
    f"SELECT doc_id AS u, {_words(chr(39) + 'search_document: ' + chr(39) + ' || text')} AS words FROM documents",
    DUPLICATE_DIMS,
)
_CLUSTERS = f"""WITH RECURSIVE {_DOC_VECS},
  pairs AS MATERIALIZED (SELECT a.u AS a, b.u AS b FROM vecs a, vecs b
    WHERE a.u <> b.u AND list_inner_product(a.v, b.v) >= 0.9 - 1e-12),
  reach(id, root) USING KEY (id) AS (
    SELECT u, u FROM vecs
    UNION
    SELECT p.a, min(r.root) FROM reach r JOIN pairs p ON p.b = r.id JOIN recurring.reach mine ON mine.id = p.a
    WHERE r.root < mine.root GROUP BY p.a),
  sized AS (SELECT id, root AS cluster_id, count(*) OVER (PARTITION BY root) AS size FROM reach),
  found AS (SELECT id, cluster_id, CASE WHEN id <> cluster_id THEN 'deletion candidate'
    WHEN size > 1 THEN 'retention candidate' ELSE 'singleton' END AS duplicate_class FROM sized)
"""

ORACLES = {
    "embed_text": f"""WITH {hash_sql(f'''SELECT doc_id AS u,
        {_words("'search_document: ' || CASE WHEN lang = 'fr' THEN 'empty text' ELSE text END")} AS words FROM documents''', DIMS)}
      SELECT u AS id, {_key("v")} AS vector FROM vecs""",
    "embed_long_text": f"""WITH w AS (SELECT doc_id, {_words("'clustering: ' || text")} AS words FROM documents),
      {hash_sql(f'''SELECT {{'id': doc_id, 'chunk': c}} AS u, words[c * {CHUNK_TOKENS} + 1 : (c + 1) * {CHUNK_TOKENS}] AS words
        FROM (SELECT doc_id, words, unnest(range(greatest(1, (len(words) + {CHUNK_TOKENS - 1}) // {CHUNK_TOKENS}))) AS c FROM w)''', DIMS)},
      {_mean_sql(DIMS)} SELECT id, {_key(_unit("m"))} AS vector FROM means""",
    "char_chunks": f"""SELECT id, c::INTEGER AS chunk, md5(substr(text, c * {CHUNK_CHARS} + 1, {CHUNK_CHARS})) AS text_md5
      FROM (SELECT doc_id AS id, text, unnest(range(greatest(1, ceil(length(text) / {CHUNK_CHARS}.0)::BIGINT))) AS c FROM documents)""",
    "pool_chunks": f"""WITH {hash_sql(f'''SELECT {{'id': id, 'chunk': c}} AS u,
        {_words(f"'search_document: ' || substr(text, c * {CHUNK_CHARS} + 1, {CHUNK_CHARS})")} AS words
        FROM (SELECT doc_id AS id, text, unnest(range(greatest(1, ceil(length(text) / {CHUNK_CHARS}.0)::BIGINT))) AS c FROM documents)''', DIMS)},
      {_mean_sql(DIMS)} SELECT id, {_key(_unit("m"))} AS vector FROM means""",
    "reuse_embeddings": """SELECT d.doc_id AS id,
      CASE WHEN l.doc_id IS NOT NULL AND quality <> 0 THEN 'kept' ELSE 'embedded' END AS vector_from
      FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "batch_embed_file": rf"""WITH {hash_sql(f'''SELECT item_id AS u,
        {_words("'search_document: ' || regexp_replace(text, '[\r\n]+', ' ', 'g')")} AS words FROM benchmark''', DIMS)}
      SELECT md5(regexp_replace(text, '[\r\n]+', ' ', 'g')) AS text_md5, {_key("v")} AS vector
      FROM vecs JOIN benchmark ON item_id = u""",
    "image_ref_kind": """SELECT page_id, url AS ref, CASE WHEN regexp_matches(lower(url), '^https?://[^/?#]+') THEN 'url' ELSE 'file' END AS kind FROM pages
      UNION ALL SELECT page_id, regexp_replace(url, '^https?://', '/images/'), 'file' FROM pages""",
    "semantic_duplicates": f"{_CLUSTERS} SELECT * FROM found",
    "deletion_candidates": f"{_CLUSTERS} SELECT id FROM found WHERE duplicate_class = 'deletion candidate'",
    "dedup_dataset": f"""{_CLUSTERS} SELECT doc_id AS id, lang, source FROM documents
      WHERE doc_id NOT IN (SELECT id FROM found WHERE duplicate_class = 'deletion candidate')""",
    "duplicate_summary": f"""{_CLUSTERS} SELECT count(*) AS rows,
      count(*) FILTER (duplicate_class = 'deletion candidate') AS deletion_candidates,
      count(*) FILTER (duplicate_class = 'retention candidate') AS clusters FROM found""",
    "largest_clusters": f"""{_CLUSTERS} SELECT cluster_id, count(*) AS size FROM found GROUP BY cluster_id
      HAVING count(*) > 1 ORDER BY size DESC, cluster_id LIMIT 10""",
}
