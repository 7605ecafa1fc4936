"""The registered queries of this package and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmap.llm import decontaminate, extract, language, neighbours, pieces, pii, quality, repair, runs, simhash, substring, toxicity, urls
from corpusmap.sources.tables import table

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


def op1_substring_dedup(spark, folder):
    """Every document without the words of repeated windows."""
    found = substring.without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "repeats.n_words", "repeats.n_removed", F.sha2("repeats.kept", 256).alias("kept_sha256"))


def op2_neighbours(spark, folder):
    """The 20 nearest rows of every twentieth vector."""
    rows = table(spark, folder, "embeddings")
    found = neighbours.nearest(rows, rows.filter("vec_id % 20 = 0"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op3_sentencepiece(spark, folder):
    """Ids of every document, and whether decoding gives the text back."""
    model = pieces.load(spark, MODEL_FILE)
    docs = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), model, exact_col="round_trip", reader=pieces.reader_of(model))
    return docs.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip")


def op4_toxicity(spark, folder):
    """Toxicity score of every document."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.train(docs, labels, ~toxicity.held_out("doc_id", 5, 0))
    return docs.select(
        "doc_id", toxicity.held_out("doc_id", 5, 0).alias("held_out"), toxicity.toxicity(spark, model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_language(spark, folder):
    """Language of every document."""
    docs, fold = table(spark, folder, "documents"), toxicity.held_out("doc_id", 3, 1)
    model = language.train(docs, ~fold)
    found = docs.select("doc_id", fold.alias("held_out"), language.identify(spark, model, F.col("text"), spans=False).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op6_decontaminate(spark, folder):
    """What every document shares with the benchmark."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "benchmark_found.n_words", "benchmark_found.n_hit",
        F.size("benchmark_found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("benchmark_found.items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op7_pii(spark, folder):
    """Personal data in every document."""
    found = table(spark, folder, "documents").select("doc_id", pii.find_pii(F.col("text")).alias("found"))
    return found.select(
        "doc_id", *[pii.count_of("found", kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.digest("found", True), 256).alias("base_sha256"), pii.digest("found", False).alias("spans"),
    )


def op8_simhash(spark, folder):
    """Fingerprint and near-duplicate class of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_print("fp").alias("fingerprint"), "component_id")


def op9_extract(spark, folder):
    """Main text of every page."""
    pages = table(spark, folder, "pages")
    found = pages.select("page_id", "url", extract.extract_text(spark, extract.train(pages), F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op10_urls(spark, folder):
    """Verdict on the url of every page."""
    found = urls.judge_urls(table(spark, folder, "pages").select("page_id", "url", "html"), URL_RULES)
    return found.select("page_id", "url_verdict.host", "url_verdict.path", "url_verdict.rule", "url_verdict.verdict")


def op11_quality(spark, folder):
    """Faults of every document, and whether it is kept."""
    trusted = table(spark, folder, "labels").filter("quality = 1")
    found = quality.assess(table(spark, folder, "documents").select("doc_id", "text"), trusted)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def with_cycles(docs):
    """Some documents made periodic from some word on, by the CRC-32 of their id."""
    h, words = F.crc32(F.col("doc_id").cast("string")), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    some = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words)).selectExpr("*", "floor(h / 10) as g", "size(w) as n")
    some = some.selectExpr("doc_id", "text", "w", "g", "n", "if(n > 0, cast(g % n as int), 0) as a")
    some = some.selectExpr("*", "cast(1 + floor((n - a) / (3 + g % 8)) as int) as p")
    cycle = "slice(flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)"
    return some.selectExpr("doc_id", f"if(n > 0, array_join(concat(slice(w, 1, a), {cycle}), ' '), text) as text")


def op12_runs(spark, folder):
    """Periodic runs of every document, and its text without their repeats."""
    docs = with_cycles(table(spark, folder, "documents").select("doc_id", "text"))
    found = docs.select("doc_id", runs.periodic(F.col("text")).alias("f"))
    more = "x.length * acc.period > acc.length * x.period"
    best = F.expr(f"if(size(f.runs) = 0, null, aggregate(slice(f.runs, 2, size(f.runs)), f.runs[0], (acc, x) -> if({more}, x, acc)))")
    listed = F.expr("array_join(transform(f.runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.expr("cast(size(f.runs) as bigint) as n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period as exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("f.collapsed", 256).alias("collapsed_sha256"),
    )


def with_damage(rows):
    """Some rows of conversations damaged, by the CRC-32 of their place."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), k.alias("k")).filter("k <> 0")
    rows = rows.withColumn("text", F.expr("case k when 1 then '' when 2 then translate(text, '.!?', '') else text end"))
    rows = rows.withColumn("role", F.expr("if(k = 4, 'user', role)"))
    return rows.withColumn("copy", F.explode(F.expr("if(k = 3, array(0, 1), array(0))"))).drop("k", "copy")


def op13_repair(spark, folder):
    """Faults of every damaged conversation, and its cheapest repair."""
    rows = table(spark, folder, "conversations")
    found = repair.digests(repair.repair(with_damage(rows), ids=rows))
    return found.select(
        F.col("id").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_neighbours, op3_sentencepiece, op4_toxicity, op5_language,
        op6_decontaminate, op7_pii, op8_simhash, op9_extract, op10_urls, op11_quality, op12_runs,
        op13_repair,
    )
}

ORACLES: dict[str, str] = {}

ORACLES["op6_decontaminate"] = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT *, least(13, len(w)) AS m, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT m FROM windows),
places AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT d.*, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM d, widths WHERE len(w) >= m)),
hits AS (SELECT doc_id, item_id, m, i FROM places JOIN windows USING (m, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op1_substring_dedup"] = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth
  FROM (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20))),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM windows WHERE nth > 1),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS s, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _walk(steps: int, damping: float, threshold: float) -> str:
    """SQL of the query ``op10_urls``: each step of both walks is a common table expression."""
    lower = lambda x: f"translate({x}, '{urls.A_TO_Z}', '{urls.A_TO_Z.lower()}')"
    fits = " ".join(
        f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
        for v, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    )
    sql = f"""
WITH u AS (
  SELECT page_id, html, {lower("coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE {fits} END AS hit FROM u),
seeds AS (
  SELECT host, avg(CASE WHEN hit LIKE 'allow %' THEN 1.0 ELSE 0.0 END) AS trusted, avg(CASE WHEN hit LIKE 'block %' THEN 1.0 ELSE 0.0 END) AS blocked
  FROM r WHERE host <> '' GROUP BY host),
links AS (
  SELECT a, b, count(*) AS n FROM (
    SELECT host AS a, {lower("unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*[\"'']?(?:https?:)?//([^/?#\"''\\s>]+)', 1))")} AS b FROM u)
  WHERE a <> b AND a <> '' GROUP BY a, b),
ways AS (
  SELECT kind, host, onto, n / sum(n) OVER (PARTITION BY kind, host) AS share
  FROM (SELECT 0 AS kind, a AS host, b AS onto, n FROM links UNION ALL SELECT 1, b, a, n FROM links)),
s0 AS (
  SELECT host, kind, {1 - damping} * seed AS score
  FROM (SELECT host, 0 AS kind, trusted AS seed FROM seeds UNION ALL SELECT host, 1, blocked FROM seeds) WHERE seed > 0)"""
    for k in range(steps):
        sql += f""",
s{k + 1} AS (
  SELECT host, kind, sum(score) AS score FROM (
    SELECT onto AS host, kind, {damping} * score * share AS score FROM ways JOIN s{k} USING (kind, host) UNION ALL SELECT host, kind, score FROM s0)
  GROUP BY host, kind)"""
    return sql + f""",
known AS (
  SELECT host, coalesce(sum(score) FILTER (kind = 0), 0) AS trust, coalesce(sum(score) FILTER (kind = 1), 0) AS distrust FROM s{steps} GROUP BY host)
SELECT page_id, host, path, nullif(split_part(coalesce(hit, ''), ' ', 2), '') AS rule,
  coalesce(nullif(split_part(coalesce(hit, ''), ' ', 1), ''), CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) + {threshold} THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN known USING (host)
"""


ORACLES["op10_urls"] = _walk(urls.STEPS, urls.DAMPING, urls.THRESHOLD)


WORD = "[^\\x20\\x09-\\x0D]+"

ORACLES["op11_quality"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
grams AS (
  SELECT doc_id, CAST('0x' || left(md5(g), 4) AS INTEGER) AS b
  FROM (SELECT doc_id, unnest(w) AS g FROM d UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM d)),
trusted AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
counts AS (SELECT b, count(*) AS raw, count(t.doc_id) AS target FROM grams LEFT JOIN trusted t USING (doc_id) GROUP BY b),
weights AS (
  SELECT b, CAST(round(1000 * ln((target + 1.0::DOUBLE) / ((SELECT sum(target) FROM counts)::DOUBLE + {quality.BUCKETS})
    / ((raw + 1.0::DOUBLE) / ((SELECT sum(raw) FROM counts)::DOUBLE + {quality.BUCKETS})))) AS BIGINT) AS x FROM counts),
scores AS (SELECT doc_id, floor(sum(x) / count(*)) AS score FROM grams JOIN weights USING (b) GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS times
  FROM (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d))),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS p FROM windows WHERE times > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(score, 0) AS score
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN scores USING (doc_id)),
judged AS (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM base),
least AS (
  SELECT max(score) FILTER (nth = 1 + n // {quality.TRUSTED_BELOW}) AS score
  FROM (SELECT score, row_number() OVER (ORDER BY score) AS nth, count(*) OVER () AS n FROM judged SEMI JOIN trusted USING (doc_id) WHERE NOT base_failed))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND judged.score >= coalesce(least.score, judged.score) AS kept
FROM judged, least
"""


def _crc32(text: str) -> str:
    """SQL of the CRC-32 of an ASCII string, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    step = "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, z: xor(d >> 1, 3988292384 * (d & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295)"


#: Five words of a run come again one period later; neighbouring such places of one shift make a stretch with that period.
ORACLES["op12_runs"] = f"""
WITH d0 AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
d1 AS (SELECT doc_id, w, h, h // 10 AS g, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d0),
d AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w FROM d1),
windows AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1:i + 5], ' ') AS win FROM (SELECT doc_id, n, w, unnest(range(0, n - 4)) AS i FROM d)),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM windows x JOIN windows y ON x.doc_id = y.doc_id AND x.win = y.win AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 5 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM pairs) GROUP BY doc_id, q, part),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
ranked AS (
  SELECT *, (1000 * length) // period AS exponent_milli, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS nth FROM runs),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS p FROM runs),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p FROM d),
collapsed AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS s FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, exponent_milli,
  sha256(coalesce(listed.s, '')) AS runs_sha256, sha256(coalesce(collapsed.s, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN collapsed USING (doc_id) LEFT JOIN (SELECT * FROM ranked WHERE nth = 1) USING (doc_id)
"""


def _moves() -> str:
    """State before, inserts with their cost, and state after them, as rows of SQL."""
    at = {"B": ("user", "U"), "S": ("user", "U"), "U": ("assistant", "A"), "A": ("user", "U")}
    rows = []
    for state in at:
        letters, lines, to = "", "", state
        for n in range(3):
            rows.append(f"('{state}', '{letters}', {3 * n}, '{lines}', '{to}')")
            letters, lines, to = letters + "I", f"{lines}\n{at[to][0]}:", at[to][1]
    return ", ".join(rows)


#: One step a row: the cheapest edits so far for each state, the audit first among equals, and the repaired lines (each after a line feed).
ORACLES["op13_repair"] = f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw WHERE k <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos FROM damaged),
faulty AS (
  SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ends, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again FROM placed),
rows AS (
  SELECT *, CASE WHEN ends = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(ends, 1) IN ('.', '!', '?') THEN '' ELSE 'truncated' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM faulty),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM rows GROUP BY conv_id),
moves(state, letters, price, lines, upto) AS (VALUES {_moves()}),
next(state, role, onto) AS (VALUES ('B', 'user', 'U'), ('S', 'user', 'U'), ('U', 'assistant', 'A'), ('A', 'user', 'U')),
keeps(state, initial, onto) AS (VALUES ('B', 's', 'S'), ('B', 'u', 'U'), ('S', 'u', 'U'), ('A', 'u', 'U'), ('U', 'a', 'A')),
edits AS (
  SELECT conv_id, pos, state, 'D' AS letter, 4 AS price, '' AS line, state AS onto FROM rows, next
  UNION ALL SELECT conv_id, pos, state, 'R', 3 + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, chr(10) || next.role || ':' || text, onto
    FROM rows, next WHERE fault IN ('', 'truncated')
  UNION ALL SELECT conv_id, pos, state, 'K', CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, chr(10) || role || ':' || text, onto
    FROM rows JOIN keeps USING (initial) WHERE fault IN ('', 'truncated')),
best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, 'B' AS state, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''}} AS e FROM facts
  UNION ALL
  SELECT b.conv_id, b.pos + 1, x.onto,
    min({{'cost': e.cost + m.price + x.price, 'audit': e.audit || m.letters || x.letter, 'lines': e.lines || m.lines || x.line}})
  FROM best b JOIN moves m USING (state) JOIN edits x ON x.conv_id IS NOT DISTINCT FROM b.conv_id AND x.pos = b.pos + 1 AND x.state = m.upto
  GROUP BY b.conv_id, b.pos, x.onto),
ended AS (
  SELECT f.conv_id, min({{'cost': e.cost + m.price, 'audit': e.audit || m.letters, 'lines': e.lines || m.lines}}) AS e
  FROM best b JOIN facts f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.n = b.pos JOIN moves m USING (state) WHERE m.upto IN ('B', 'A') GROUP BY f.conv_id)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(e.cost, 0) AS cost, coalesce(e.audit, '') AS audit,
  sha256(coalesce(substr(e.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM i.conv_id
  LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM i.conv_id
"""
