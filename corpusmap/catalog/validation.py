"""Queries over types, names, ids and values."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from corpusmap.functions import text, times, vectors
from corpusmap.operators import checks, rows, schema
from corpusmap.sources.tables import table


def coerce_schema(spark, folder):
    stored = schema.coerce(table(spark, folder, "orders"))
    return stored.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.round(F.col("o_totalprice").cast("double"), 1).alias("o_totalprice"),
        times.as_text(F.col("o_orderdate")).alias("o_orderdate"),
        "o_orderpriority",
    )


def conform_rows(spark, folder):
    # Keys beyond 32 bits wrap; the extra columns go; fractions are cut.
    later = table(spark, folder, "orders").withColumn("o_orderkey", F.col("o_orderkey") * 1000003)
    target = T.StructType(
        [
            T.StructField("o_orderpriority", T.StringType()),
            T.StructField("o_orderkey", T.IntegerType()),
            T.StructField("o_totalprice", T.IntegerType()),
        ]
    )
    return schema.conform(later, target)


def validate_ids(spark, folder):
    docs = table(spark, folder, "documents")
    by_text = docs.select(F.when(F.col("lang") != "fr", F.col("text")).alias("text_id"))
    by_number = docs.select("doc_id")
    return checks.validate_ids(by_text, "text_id").unionByName(checks.validate_ids(by_number, "doc_id"))


def fill_null_strings(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id",
        F.nullif("lang", F.lit("fr")).alias("lang"),
        F.regexp_replace("source", "^src1.*$", "").alias("source"),
        F.md5("text").alias("text"),
    )
    return schema.fill_null_strings(docs)


def validate_vectors(spark, folder):
    scaled = table(spark, folder, "embeddings").select(
        F.transform("embedding", lambda x: x * F.lit(200000.0).cast("float")).alias("v")
    )
    plain = table(spark, folder, "embeddings")
    return checks.validate_vectors(scaled, "v", half=True).unionByName(
        checks.validate_vectors(plain, "embedding", half=True)
    )


def infer_categorical(spark, folder):
    return checks.infer_color_fields(table(spark, folder, "lineitem"), "l_orderkey")


def stringify_low_card(spark, folder):
    lines = table(spark, folder, "lineitem").drop("l_shipdate", "l_suppkey")
    return checks.stringify_few_valued(lines, "l_orderkey")


def unbatch(spark, folder):
    v = F.col("embedding")
    batches = table(spark, folder, "embeddings").select(
        "vec_id",
        F.array(*[F.slice(v, 16 * i + 1, 16) for i in range(4)]).alias("vectors"),
        F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.col("label") * 10 + i).alias("class"),
    )
    flat = checks.unbatch(batches, "vectors", ["class"])
    return flat.select("vec_id", "class", vectors.vector_key(F.col("vectors")).alias("vector"))


def slug_keys(spark, folder):
    turns = table(spark, folder, "conversations")
    keys = rows.derived(turns, "key", "/", ["role", "text"])
    return checks.slug_report(keys, "key").select(F.md5("slug").alias("slug_md5"), "n", "invalid")


def b64_ids(spark, folder):
    return table(spark, folder, "supplier").select(
        "s_suppkey",
        text.compact_key(F.col("s_suppkey")).alias("key"),
        text.compact_key(F.col("s_suppkey") * 7919 * 104729).alias("long_key"),
    )


def trunc_ms(spark, folder):
    shifted = F.col("ts") - F.expr("INTERVAL 100 YEARS")
    return table(spark, folder, "events").select(
        "event_id",
        times.as_text(times.truncate_ms(F.col("ts"))).alias("ts"),
        times.as_text(times.truncate_ms(shifted)).alias("old_ts"),
    )


def profile_table(spark, folder):
    return checks.profile(table(spark, folder, "documents"))


def precision_recall(spark, folder):
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    flagged = docs.select(
        (F.size(text.tokens(F.col("text"))) < 100).alias("predicted"), (F.col("quality") == 0).alias("actual")
    )
    scores = rows.precision_recall(flagged, "predicted", "actual")
    return scores.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


def token_usage(spark, folder):
    docs = table(spark, folder, "documents")
    used = docs.select("lang", F.size(text.tokens(F.col("text"))).alias("tokens"))
    return used.groupBy("lang").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("tokens").alias("total_tokens")
    )


def category_timeline(spark, folder):
    found = rows.category_timeline(table(spark, folder, "events"), "ts", "event_type", "1 day")
    return found.withColumn("bucket", times.as_text(F.col("bucket")))


def time_filter(spark, folder):
    ev = table(spark, folder, "events")
    kept = ev.filter(times.between(F.col("ts"), "2024-01-05 00:00:00", "2024-01-12 23:59:59"))
    return kept.select("event_id", "event_type", "value")


QUERIES = {
    f.__name__: f
    for f in (
        coerce_schema, conform_rows, validate_ids, fill_null_strings, validate_vectors, infer_categorical,
        stringify_low_card, unbatch, slug_keys, b64_ids, trunc_ms, profile_table, precision_recall,
        token_usage, category_timeline, time_filter,
    )
}

_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%g')"
_TOKENS = r"len(regexp_extract_all(lower(text), '\p{L}+'))"
_LINEITEM = {
    "l_partkey": "int", "l_suppkey": "int", "l_linenumber": "int", "l_quantity": "int",
    "l_extendedprice": "int", "l_discount": "int", "l_tax": "int", "l_returnflag": "str",
    "l_linestatus": "str", "l_shipdate": "time",
}


def _profile_sql(columns: dict[str, bool]) -> str:
    parts = []
    for c, is_text in columns.items():
        empties = f"count(*) FILTER ({c} = '')" if is_text else "0::BIGINT"
        longest = f"max(length({c}))::BIGINT" if is_text else "NULL::BIGINT"
        parts.append(
            f"SELECT '{c}' AS field, count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls, "
            f"{empties} AS empties, {longest} AS max_length FROM documents"
        )
    return " UNION ALL ".join(parts)


ORACLES = {
    "coerce_schema": f"""SELECT o_orderkey::INTEGER AS o_orderkey, o_custkey::INTEGER AS o_custkey, o_orderstatus,
      round(o_totalprice::FLOAT::DOUBLE, 1) AS o_totalprice,
      {_STAMP.format("o_orderdate")} AS o_orderdate, o_orderpriority FROM orders""",
    "conform_rows": """SELECT o_orderpriority, trunc(o_totalprice)::INTEGER AS o_totalprice,
      (((o_orderkey * 1000003 + 2147483648) % 4294967296) - 2147483648)::INTEGER AS o_orderkey FROM orders""",
    "validate_ids": """
      SELECT 'null id' AS rule, 'text_id' AS field, count(*) FILTER (lang = 'fr') AS n FROM documents
      UNION ALL SELECT 'id too long', 'text_id', count(*) FILTER (lang <> 'fr' AND length(text) > 36) FROM documents
      UNION ALL SELECT 'null id', 'doc_id', count(*) FILTER (doc_id IS NULL) FROM documents
      UNION ALL SELECT 'id too long', 'doc_id', count(*) FILTER (length(doc_id::VARCHAR) > 36) FROM documents""",
    "fill_null_strings": """SELECT doc_id, coalesce(nullif(lang, 'fr'), 'null') AS lang,
      CASE WHEN source LIKE 'src1%' THEN 'null' ELSE source END AS source, md5(text) AS text FROM documents""",
    "validate_vectors": " UNION ALL ".join(
        f"""SELECT 'no rows' AS rule, '{f}' AS field, (count(*) = 0)::BIGINT AS n FROM embeddings
        UNION ALL SELECT 'null vector', '{f}', count(*) FILTER (embedding IS NULL) FROM embeddings
        UNION ALL SELECT 'lengths differ', '{f}', (min(len(embedding)) <> max(len(embedding)))::BIGINT FROM embeddings
        UNION ALL SELECT 'invalid component', '{f}',
          count(*) FILTER (len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) > 0) FROM embeddings
        UNION ALL SELECT 'half overflow', '{f}', count(*) FILTER
          (len(list_filter(embedding, lambda x: abs((x * {scale}::FLOAT)::DOUBLE) >= 65520)) > 0) FROM embeddings"""
        for f, scale in (("v", 200000.0), ("embedding", 1.0))
    ),
    "infer_categorical": " UNION ALL ".join(
        f"""SELECT '{c}' AS field, {kind == 'int'} AS numeric, false AS named,
        count(DISTINCT {c}) <= 10 AS few_values, {kind == 'int'} OR count(DISTINCT {c}) <= 10 AS color FROM lineitem"""
        for c, kind in _LINEITEM.items()
    ),
    "stringify_low_card": """SELECT l_orderkey, l_partkey, l_linenumber::VARCHAR AS l_linenumber, l_quantity,
      l_extendedprice, l_discount, l_tax::VARCHAR AS l_tax, l_returnflag, l_linestatus FROM lineitem""",
    "unbatch": """SELECT vec_id, (label * 10 + i)::INTEGER AS class,
      list_aggregate(list_transform((embedding::DOUBLE[])[i * 16 + 1 : i * 16 + 16],
        lambda x: round(x * 1e4)::BIGINT::VARCHAR), 'string_agg', ',') AS vector
      FROM embeddings, range(0, 4) t(i)""",
    "slug_keys": r"""WITH k AS (SELECT role, text FROM conversations),
      s AS (SELECT role || '/' || regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(text)), '[ _]', '-', 'g'),
        '[^a-z0-9-]', '', 'g'), '-+', '-', 'g') AS slug, contains(text, '/') AS bad FROM k)
      SELECT md5(slug) AS slug_md5, count(*) AS n, count(*) FILTER (bad) AS invalid FROM s GROUP BY slug""",
    "b64_ids": "SELECT s_suppkey, "
    + ", ".join(
        f"rtrim(to_base64(unhex(CASE WHEN length(to_hex({e})) % 2 = 1 THEN '0' ELSE '' END || to_hex({e}))), '=') AS {a}"
        for e, a in (("s_suppkey", "key"), ("(s_suppkey * 7919 * 104729)", "long_key"))
    )
    + " FROM supplier",
    "trunc_ms": f"""SELECT event_id, {_STAMP.format("date_trunc('millisecond', ts)")} AS ts,
      {_STAMP.format("date_trunc('millisecond', ts - INTERVAL 100 YEAR)")} AS old_ts FROM events""",
    "profile_table": _profile_sql(
        {"doc_id": False, "text": True, "lang": True, "source": True, "n_chars": False}
    ),
    "precision_recall": f"""WITH f AS (SELECT {_TOKENS} < 100 AS p, quality = 0 AS a
      FROM documents JOIN labels USING (doc_id)),
      c AS (SELECT count(*) FILTER (p AND a) AS tp, count(*) FILTER (p AND NOT a) AS fp,
        count(*) FILTER (NOT p AND a) AS fn, count(*) FILTER (NOT p AND NOT a) AS tn FROM f)
      SELECT *, round(tp / nullif(tp + fp, 0), 6)::DOUBLE AS precision,
        round(tp / nullif(tp + fn, 0), 6)::DOUBLE AS recall FROM c""",
    "token_usage": f"""SELECT lang, count(*) AS texts, sum({_TOKENS})::BIGINT AS total_tokens
      FROM documents GROUP BY lang""",
    "category_timeline": f"""SELECT {_STAMP.format("date_trunc('day', ts)")} AS bucket, event_type AS category, count(*) AS n
      FROM events GROUP BY ALL""",
    "time_filter": """SELECT event_id, event_type, value FROM events
      WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 23:59:59'""",
}
