"""Every operator over short, null, empty, very long and repeated rows, and beside columns that clash with names of its own."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmap.llm import decontaminate, extract, overlap, queries, substring
from corpusmap.llm.common import fresh

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 5000} said" for i in range(60_000))
CASES = {
    "short": [(i, t, "en", "s", len(t)) for i, t in enumerate(["two words", "a b", "x", "one two three", "two words"])],
    "null": [(1, None, None, None, None), (None, None, "en", "s", 0), (2, "", "de", "s", 0), (None, "", None, "s", 0), (3, " \n", "fr", "s", 2)],
    "empty": [],
    "long": [(1, LONG, "en", "s", len(LONG)), (1, LONG, "en", "s", len(LONG)), (2, "word " * 50_000, "en", "s", 250_000), (3, LONG.replace(" ", ""), "en", "s", 9)],
}


@pytest.fixture
def folder(spark, tmp_path):
    def make(rows, vectors=((1, [1.0, 0.0], 1),)):
        save = lambda name, rows, kind: spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
        save("documents", rows, DOCS)
        save("labels", [(r[0], 1, 0) for r in rows if r[0] is not None][:3], "doc_id bigint, quality int, toxic int")
        save("benchmark", [(1, "a b"), (2, None), (3, "word " * 20)], "item_id bigint, text string")
        save("embeddings", [] if not rows else list(vectors), "vec_id bigint, embedding array<float>, label int")
        save("pages", [(r[0], "http://a.org/x" if i else None, f"<p>{r[1]}" if r[1] else r[1]) for i, r in enumerate(rows)], "page_id bigint, url string, html string")
        save("conversations", [(r[0], i, "user", r[1]) for i, r in enumerate(rows)], "conv_id bigint, turn bigint, role string, text string")
        return str(tmp_path)

    return make


@pytest.mark.parametrize("case", sorted(CASES))
def test_all_queries(spark, folder, case):
    path, rows = folder(CASES[case]), CASES[case]
    for name, query in queries.QUERIES.items():
        found = query(spark, path).collect()
        if name.startswith("op13"):
            assert len(found) == len({r[0] for r in rows}), name
        elif not name.startswith("op2_"):
            assert len(found) == len(rows), name
    kept = corpus_pipeline.run(spark, path).collect()
    assert len(kept) <= len(rows) and (len(kept) > 0) == (len(rows) > 0)


NAMES = (
    "repeats id tie repeat_key repeat_found repeat_ranges url_host url_found url_known url_verdict host piece_out piece_key token_ids "
    "near_key row_mark key mark label benchmark_found benchmark_more toxicity_score fp s size"
).split()


def test_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (2, text + " x"), (3, "other words"), (None, None)], "doc_id bigint, text string")
    docs = docs.withColumns({n: F.lit(n) for n in NAMES})
    own = lambda rows, lost=(): all(r[n] == n for r in rows for n in NAMES if n not in lost)
    found = substring.without_repeats(docs).collect()
    assert len(found) == 4 and own(found, ["repeats"]) and {r.doc_id: r.repeats.n_removed for r in found}[2] == 30
    assert own(overlap.one_of_each(docs).collect())
    folder = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns and own(kept.collect()), name
    assert own(corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect(), ["token_ids"])
    pages = docs.select("*", F.lit("http://a.b/c").alias("url"), F.lit("<a href='http://c.d/'>").alias("html"))
    judged = queries.urls.judge_urls(pages, queries.URL_RULES).collect()
    assert own(judged, ["url_verdict"]) and all(r.url_verdict.host == "a.b" for r in judged)
    assert fresh("ID", docs) == "ID_"


def test_one_row_of_each_class(spark):
    """A text whose id also stands on a row of another class stays, if nobody is near it."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, "nothing like it at all"), (2, text), (2, text), (None, text), (None, "only here, without an id"), (5, None), (4, None), (4, None)]
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), "").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted([(1, text), (1, "nothing like it at all"), (0, "only here, without an id"), (4, "")])


def test_longest_match():
    """The first of the longest common sequences, and no walk over all pairs of places."""
    rng = random.Random(6)
    for _ in range(300):
        own, text = ([rng.randrange(1, 4) for _ in range(rng.randrange(1, 30))] for _ in range(2))
        text = [w if rng.random() < 0.9 else 0 for w in text]
        best = (0, 0, 0)
        for i in range(len(text)):
            for j in range(len(own)):
                n = 0
                while i + n < len(text) and j + n < len(own) and text[i + n] == own[j + n]:
                    n += 1
                best = (n, i, j) if n > best[0] else best
        assert decontaminate.Suffixes(own).longest(text) == best
    items = decontaminate.Items([("a", b"w " * 10_000)])
    (found,) = decontaminate.find(items, [b"w " * 100_000])
    assert found["spans"] == [{"start": 0, "end": 100_000}] and found["matches"][0]["length"] == 10_000


def test_markup_stays_out():
    texts = lambda page: [b.text for b in extract.blocks(page)]
    assert texts('<p title="a < b">hello') == ["hello"]
    assert texts("""<div data-x='{"a":"<b>"}'>text""") == ["text"]
    assert texts("<p>a</p><!--><p>hello there</p>") == texts("<p>a</p><!---><p>hello there</p>") == ["a", "hello there"]
    assert texts("<p don't>it</p> a < b <i>x</i>") == ["it", "a < b x"]
    assert texts("<p class=\"a\"/>w<!-- > --!>v") == ["wv"]


@pytest.mark.parametrize("page", ["<div><p>x" * 10_000, "<div class=a>x" * 10_000, "</p>" * 20_000 + "<div>" * 10_000 + "</p>x" * 10_000, "<a b='\"c" * 20_000])
def test_deep_pages(page):
    import time

    start = time.process_time()
    extract.blocks(page)
    assert time.process_time() - start < 3
