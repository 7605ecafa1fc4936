"""Queries over tags and document jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmap.operators import documents, tag_blocks, tags
from corpusmap.session import cut_lineage
from corpusmap.sources.tables import table

#: A conversation as one record: who spoke first, and the utterances with their length.
DIALOGUE = {
    "type": "object",
    "properties": {
        "opened_by": {"type": "string"},
        "utterances": {
            "type": "array",
            "items": {
                "type": "object",
                "properties": {
                    "speaker": {"type": "string"},
                    "said": {"type": "object", "properties": {"chars": {"type": "integer"}, "words": {"type": "string"}}},
                },
            },
        },
    },
}


def _tagged(spark, folder):
    labels = table(spark, folder, "labels")
    names = F.array_compact(
        F.array(
            F.when(F.col("toxic") == 1, "toxic"),
            F.when(F.col("quality") == 0, "low-quality"),
            F.when(F.col("quality") == 1, "good"),
        )
    )
    return labels.select(F.col("doc_id").alias("id"), F.explode(names).alias("tag"))


def _definitions(spark, folder):
    """Tags that occur; ``good`` is still being computed."""
    return _tagged(spark, folder).select("tag").distinct().withColumn("complete", F.col("tag") != "good")


def _docs(spark, folder):
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang")


def _seats(spark, folder):
    """Seats of the documents, whose tiles are their sources here."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.lit(0).alias("level"), F.col("source").alias("tile"))
    seats = cut_lineage(tag_blocks.seat_rows(docs))
    return seats, tag_blocks.blocks_of(seats)


def tag_table(spark, folder):
    seats, blocks = _seats(spark, folder)
    held = tag_blocks.tagged_rows(seats, tag_blocks.stored(seats, blocks, _tagged(spark, folder)))
    wide = tags.tag_table(_docs(spark, folder), held, _definitions(spark, folder))
    return wide.withColumnRenamed("low-quality", "low_quality")


def tag_rows(spark, folder):
    seats, blocks = _seats(spark, folder)
    store = tag_blocks.stored(seats, blocks, _tagged(spark, folder)).filter("tag = 'toxic'")
    return tags.rows_in_tag(_docs(spark, folder), tag_blocks.tagged_rows(seats, store), "toxic")


def tag_block_counts(spark, folder):
    """Lines of the store: rows of each tag and tile, and whether that is all of the tile's rows."""
    seats, blocks = _seats(spark, folder)
    every = _docs(spark, folder).select("id", F.lit("any").alias("tag"))
    store = tag_blocks.stored(seats, blocks, _tagged(spark, folder).unionByName(every))
    lines = store.join(blocks, "block").groupBy("tag", "tile")
    return lines.agg(F.sum("n").alias("n"), F.bool_and(F.col("bits").isNull()).alias("all_set"))


def list_tags(spark, folder):
    return tags.list_tags(_definitions(spark, folder))


def tag_counts(spark, folder):
    found = tags.tag_counts(_tagged(spark, folder))
    return found.withColumn("sample_ids", F.array_join(F.col("sample_ids").cast("array<string>"), ","))


def tag_add_remove(spark, folder):
    docs, (seats, blocks) = _docs(spark, folder), _seats(spark, folder)
    store = tag_blocks.stored(seats, blocks, _tagged(spark, folder))
    german = docs.filter("lang = 'de'").select("id", F.explode(F.array(F.lit("german"), F.lit("toxic"))).alias("tag"))
    grown = cut_lineage(tag_blocks.with_tags(store, tag_blocks.stored(seats, blocks, german), blocks))
    english = docs.filter("lang = 'en'").select("id", F.lit("toxic").alias("tag"))
    return tag_blocks.tagged_rows(seats, tag_blocks.without_tags(grown, tag_blocks.stored(seats, blocks, english), blocks))


def prune_tags(spark, folder):
    live = _definitions(spark, folder).filter("complete")
    return tags.prune(_tagged(spark, folder), live)


def _files(spark, folder):
    """Each page as files of several formats: leading bytes, then the page."""
    kinds = [
        ("pdf", "255044462D"), ("png", "89504E470D0A1A0A"), ("jpg", "FFD8FFE0"), ("docx", "504B0304"),
        ("xlsx", "504B0304"), ("jar", "504B0304"), ("webp", "524946460000000057454250"), ("html", ""),
    ]
    kind = F.explode(F.array(*[F.struct(F.lit(e).alias("ext"), F.lit(m).alias("magic")) for e, m in kinds]))
    return table(spark, folder, "pages").select("page_id", "html", kind.alias("kind")).select(
        F.concat(F.lit("/files/"), F.col("page_id").cast("string"), F.lit("."), F.col("kind.ext")).alias("path"),
        F.concat(F.unhex("kind.magic"), F.col("html").cast("binary")).alias("content"),
    )


def detect_content_type(spark, folder):
    known, unknown = documents.detect_content_types(_files(spark, folder))
    return known.unionByName(unknown).select("path", "content_type")


def classify_urls(spark, folder):
    url = F.col("url")
    links = table(spark, folder, "pages").select(
        "page_id",
        F.explode(
            F.array(
                url,
                F.regexp_replace(url, "^https?:", "ftp:"),
                F.regexp_replace(url, "^https?:/", "file:"),
                F.regexp_replace(url, "^https?://", ""),
            )
        ).alias("url"),
    )
    return links.select("page_id", "url", F.coalesce(documents.link_problem(F.col("url")), F.lit("ok")).alias("status"))


def parse_pages(spark, folder):
    parsed = documents.parse_pages(table(spark, folder, "pages").select("page_id", "html"))
    return documents.block_rows(parsed, "page_id")


def parse_pages_full(spark, folder):
    """The same blocks of pages whose non-ASCII characters are written as numeric references."""
    character = lambda c: F.when(F.ascii(c) > 127, F.concat(F.lit("&#"), F.ascii(c).cast("string"), F.lit(";"))).otherwise(c)
    written = F.array_join(F.transform(F.split("html", ""), character), "")
    parsed = documents.parse_pages(table(spark, folder, "pages").select("page_id", written.alias("html")))
    return documents.block_rows(parsed, "page_id")


def extract_json(spark, folder):
    schema = {"type": "object", "properties": {"k": {"type": "integer"}}}
    found = documents.extract_json(table(spark, folder, "events").select("event_id", "props"), "props", schema)
    return found.select("event_id", "result.k")


def extract_dialogue(spark, folder):
    said = F.struct(F.char_length("text").alias("chars"), F.col("text").alias("words"))
    utterance = F.struct(F.col("role").alias("speaker"), said.alias("said"))
    record = F.struct(F.col("role").alias("opened_by"), F.array(utterance).alias("utterances"))
    files = table(spark, folder, "conversations").select("conv_id", "turn", F.to_json(record).alias("file"))
    found = documents.extract_json(files, "file", DIALOGUE)
    found = found.select("conv_id", "turn", "result.opened_by", F.inline("result.utterances"))
    return found.select("conv_id", "turn", "opened_by", "speaker", "said.chars", "said.words")


def extract_page_fields(spark, folder):
    patterns = {"title": r"(?is)<title>(.*?)</title>", "lang": r'(?i)<html lang="([a-z]+)"'}
    found = documents.extract_fields(table(spark, folder, "pages").select("page_id", "html"), "html", patterns)
    return found.select("page_id", "result.title", "result.lang")


QUERIES = {
    f.__name__: f
    for f in (
        tag_table, tag_rows, tag_block_counts, list_tags, tag_counts, tag_add_remove, prune_tags, detect_content_type,
        classify_urls, parse_pages, parse_pages_full, extract_json, extract_dialogue, extract_page_fields,
    )
}

_TAGGED = """tagged AS (SELECT doc_id AS id, 'toxic' AS tag FROM labels WHERE toxic = 1
  UNION ALL SELECT doc_id, CASE quality WHEN 0 THEN 'low-quality' ELSE 'good' END FROM labels)"""
_EXT = "regexp_extract(path, '[.]([a-z]+)$', 1)"


# What the checks know of pages, stated apart from the parser: tags that don't break a block, kinds of block, references.
_INLINE = "a|abbr|b|bdi|bdo|button|cite|code|em|i|img|input|kbd|label|link|mark|meta|path|q|s|small|span|strong|sub|sup|svg|time|u|var|wbr|textarea|select|option|iframe|noscript"
_KINDS = "title|h[1-6]|p|li|td|th|pre|blockquote|caption|figcaption|dt|dd"
_REFERENCES = [
    ("&nbsp;?", " "), ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;", "''"), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&"),
]


def _clean_sql() -> str:
    """Blocks begin with chr(1), the name of their tag and chr(2); inline tags go first, what is left breaks."""
    c = r"regexp_replace(html, '(?is)<!--.*?-->|<script[^>]*>.*?</script\s*>|<style[^>]*>.*?</style\s*>', ' ', 'g')"
    c = rf"regexp_replace({c}, '(?i)<br\s*/?>', ' ', 'g')"
    c = rf"regexp_replace({c}, '(?i)</?(?:{_INLINE})(?:\s[^>]*)?/?>|<![^>]*>', '', 'g')"
    c = rf"regexp_replace({c}, '(?i)<({_KINDS})(?:\s[^>]*)?>', chr(1) || '\1' || chr(2), 'g')"
    return f"regexp_replace({c}, '<[^>]*>', chr(1) || chr(2), 'g')"


def _body_sql() -> str:
    c = "regexp_replace(piece, '^[A-Za-z0-9]*' || chr(2), '')"
    for reference, plain in _REFERENCES:
        c = f"regexp_replace({c}, '{reference}', '{plain}', 'g')"
    return rf"trim(regexp_replace({c}, '[ \t\r\n]+', ' ', 'g'))"


ORACLES = {
    "tag_table": f"""WITH {_TAGGED} SELECT doc_id AS id,
      doc_id IN (SELECT id FROM tagged WHERE tag = 'toxic') AS toxic,
      doc_id IN (SELECT id FROM tagged WHERE tag = 'low-quality') AS low_quality FROM documents""",
    "tag_rows": "SELECT doc_id AS id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    "tag_block_counts": f"""WITH {_TAGGED}, every AS (SELECT * FROM tagged UNION SELECT doc_id, 'any' FROM documents)
      SELECT tag, source AS tile, count(*) AS n, count(*) = any_value(size) AS all_set FROM every JOIN documents ON doc_id = id
      JOIN (SELECT source, count(*) AS size FROM documents GROUP BY source) USING (source) GROUP BY tag, source""",
    "list_tags": f"WITH {_TAGGED} SELECT DISTINCT tag FROM tagged WHERE tag <> 'good'",
    "tag_counts": f"""WITH {_TAGGED}, r AS (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY id) AS r FROM tagged)
      SELECT tag, count(*) AS n, string_agg(id::VARCHAR, ',' ORDER BY id) FILTER (r <= 10) AS sample_ids FROM r GROUP BY tag""",
    "tag_add_remove": f"""WITH {_TAGGED},
      grown AS (SELECT * FROM tagged UNION SELECT doc_id, t FROM documents, (VALUES ('german'), ('toxic')) v(t) WHERE lang = 'de')
      SELECT g.id, g.tag FROM grown g JOIN documents d ON d.doc_id = g.id WHERE NOT (tag = 'toxic' AND lang = 'en')""",
    "prune_tags": f"WITH {_TAGGED} SELECT id, tag FROM tagged WHERE tag <> 'good'",
    "detect_content_type": f"""WITH f AS (SELECT '/files/' || page_id || '.' || ext AS path
        FROM pages, (VALUES ('pdf'), ('png'), ('jpg'), ('docx'), ('xlsx'), ('jar'), ('webp'), ('html')) v(ext))
      SELECT path, CASE {_EXT} WHEN 'pdf' THEN 'application/pdf' WHEN 'png' THEN 'image/png' WHEN 'jpg' THEN 'image/jpeg'
        WHEN 'webp' THEN 'image/webp' WHEN 'docx' THEN '{documents.ZIP_OFFICE[".docx"]}'
        WHEN 'xlsx' THEN '{documents.ZIP_OFFICE[".xlsx"]}' END AS content_type FROM f""",
    "classify_urls": """SELECT page_id, url, 'ok' AS status FROM pages
      UNION ALL SELECT page_id, regexp_replace(url, '^https?:', 'ftp:'), 'unsupported scheme' FROM pages
      UNION ALL SELECT page_id, regexp_replace(url, '^https?:/', 'file:'), 'local file' FROM pages
      UNION ALL SELECT page_id, regexp_replace(url, '^https?://', ''),
        CASE WHEN regexp_matches(regexp_replace(url, '^https?://', ''), '^[A-Za-z][A-Za-z0-9+.-]*:') THEN 'unsupported scheme'
        ELSE 'no scheme' END FROM pages""",
    "parse_pages": f"""WITH c AS (SELECT page_id, string_split({_clean_sql()}, chr(1)) AS pieces FROM pages),
      p AS (SELECT page_id, unnest(pieces) AS piece, unnest(range(len(pieces))) AS n FROM c),
      b AS (SELECT page_id, n, lower(regexp_extract(piece, '^([A-Za-z0-9]*)' || chr(2), 1)) AS kind, {_body_sql()} AS text FROM p)
      SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY n) - 1)::INTEGER AS position,
        CASE WHEN regexp_full_match(kind, 'h[1-6]') THEN 'heading' WHEN kind = '' THEN 'text' ELSE kind END AS kind,
        CASE WHEN regexp_full_match(kind, 'h[1-6]') THEN kind[2]::INTEGER END AS level, text FROM b WHERE text <> ''""",
    "extract_json": "SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events",
    "extract_dialogue": "SELECT conv_id, turn, role AS opened_by, role AS speaker, length(text) AS chars, text AS words FROM conversations",
    "extract_page_fields": """SELECT page_id, nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '') AS title,
      nullif(regexp_extract(html, '(?i)<html lang="([a-z]+)"', 1), '') AS lang FROM pages""",
}
ORACLES["parse_pages_full"] = ORACLES["parse_pages"]
