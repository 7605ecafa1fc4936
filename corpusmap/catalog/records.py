"""Queries over ingest, point reads, sampling and row sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmap.functions import vectors
from corpusmap.operators import rows
from corpusmap.session import scratch_path
from corpusmap.sources import records
from corpusmap.sources.tables import table


def ingest_records(spark, folder):
    customers = table(spark, folder, "customer")
    path = scratch_path(spark, "records")
    customers.write.json(path)
    return records.ingest(spark, records.ingest_json(spark, path, customers.schema))


def drop_generated_cols(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("__index_level_0__", F.col("l_linenumber"))
    return records.ingest(spark, lines).drop("l_shipdate")


def attach_embeddings(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang")
    vecs = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    both = records.attach_vectors(docs, vecs, "id", "embedding")
    return both.select("id", "lang", F.coalesce(vectors.vector_key(F.col("_embeddings")), F.lit("")).alias("vector"))


def blob_hash(spark, folder):
    pages = table(spark, folder, "pages")
    return pages.select("page_id", records.blob_hash(F.col("html")).alias("_blob_hash"))


def attach_blob_hash(spark, folder):
    # Only the secure pages were uploaded; the others keep a null hash.
    pages = table(spark, folder, "pages")
    blobs = pages.filter(F.col("url").startswith("https")).select(
        "page_id", records.blob_hash(F.col("html")).alias("_blob_hash")
    )
    return records.attach_blobs(pages.select("page_id", "url"), blobs, "page_id")


def keyset_page(spark, folder):
    properties, _ = records.split_export(
        table(spark, folder, "customer"), "c_custkey", "c_acctbal", exclude=("c_mktsegment",)
    )
    return records.keyset_page(properties, "c_custkey", 40, 100)


def sample_n(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return rows.sample(docs, 100, seed=42, id_col="doc_id")


def sample_replaced(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return rows.sample_with_replacement(docs, 0.5, seed=42, id_col="doc_id")


def get_by_ids(spark, folder):
    orders = table(spark, folder, "orders").drop("o_orderdate")
    buyers = table(spark, folder, "customer").filter("c_acctbal > 9000").select(
        F.col("c_custkey").alias("o_custkey")
    )
    return rows.by_ids(orders, buyers, "o_custkey")


def delete_rows(spark, folder):
    orders = table(spark, folder, "orders").drop("o_orderdate")
    returned = table(spark, folder, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey")
    )
    return rows.without_ids(orders, returned, "o_orderkey")


def cap_rows(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return rows.cap(docs, 150, "doc_id")


def unpivot_text(spark, folder):
    parts = table(spark, folder, "part")
    return rows.translations(parts, ["p_partkey"], {"name": "p_name", "brand": "p_brand", "type": "p_type"})


def derive_column(spark, folder):
    turns = table(spark, folder, "conversations")
    named = rows.derived(
        turns, "label", "-", [F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.col("turn").cast("string"), "role"]
    )
    return named.select("conv_id", "turn", "label")


def union_tiles(spark, folder):
    def keys(name, key, text):
        return table(spark, folder, name).select(F.col(key).alias("id"), F.col(text).alias("name"))

    return rows.union(
        [keys("customer", "c_custkey", "c_name"), keys("supplier", "s_suppkey", "s_name"), keys("part", "p_partkey", "p_name")]
    )


def append_new_ids(spark, folder):
    # The labelled documents are stored already; the whole corpus arrives again.
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    stored = docs.join(table(spark, folder, "labels"), "doc_id", "left_semi")
    return rows.new_rows(docs.unionAll(stored), stored, "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        ingest_records, drop_generated_cols, attach_embeddings, blob_hash, attach_blob_hash, keyset_page,
        sample_n, sample_replaced, get_by_ids, delete_rows, cap_rows, unpivot_text, derive_column, union_tiles,
        append_new_ids,
    )
}

ORACLES = {
    "ingest_records": "SELECT * FROM customer",
    "drop_generated_cols": "SELECT * EXCLUDE (l_shipdate) FROM lineitem",
    "attach_embeddings": """SELECT doc_id AS id, lang, coalesce(list_aggregate(list_transform(embedding::DOUBLE[],
      lambda x: round(x * 1e4)::BIGINT::VARCHAR), 'string_agg', ','), '') AS vector
      FROM documents LEFT JOIN embeddings ON doc_id = vec_id""",
    "blob_hash": "SELECT page_id, sha256(html) AS _blob_hash FROM pages",
    "attach_blob_hash": """SELECT page_id, url, CASE WHEN url LIKE 'https%' THEN sha256(html) END AS _blob_hash FROM pages""",
    "keyset_page": "SELECT c_custkey, c_name FROM customer WHERE c_custkey > 40 ORDER BY c_custkey LIMIT 100",
    "sample_replaced": f"""SELECT doc_id, lang, source FROM (
      SELECT doc_id, lang, source, unnest(range(list_count(list_filter({rows.poisson_bounds(0.5)},
        lambda b: CAST('0x' || left(md5('42:' || doc_id::VARCHAR), 8) AS BIGINT) >= b)))) FROM documents)""",
    "sample_n": """SELECT doc_id, lang, source FROM documents ORDER BY md5('42:' || doc_id::VARCHAR), doc_id LIMIT 100""",
    "get_by_ids": """SELECT * EXCLUDE (o_orderdate) FROM orders
      WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)""",
    "delete_rows": """SELECT * EXCLUDE (o_orderdate) FROM orders
      WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "cap_rows": "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 150",
    "unpivot_text": """SELECT p_partkey, 'name' AS language, p_name AS text FROM part
      UNION ALL SELECT p_partkey, 'brand', p_brand FROM part UNION ALL SELECT p_partkey, 'type', p_type FROM part""",
    "derive_column": "SELECT conv_id, turn, 'c' || conv_id || '-' || turn || '-' || role AS label FROM conversations",
    "union_tiles": """SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL
      SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT p_partkey, p_name FROM part""",
    "append_new_ids": """SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
}
