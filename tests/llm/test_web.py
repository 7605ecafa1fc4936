"""Vectors, pages, urls and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmap.llm import decontaminate, extract, neighbours, simhash, urls


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(900, 16)).astype("f4")
    v[300:500] = v[3]  # a third of all rows are one vector
    rows = [(i, x.tolist(), "n") for i, x in enumerate(v)]
    bad = [(2000, None, ""), (2020, [0.0] * 16, ""), (2040, [float("nan")] * 16, ""), (2060, [1.0] * 15 + [None], ""), (None, [1.0] * 16, "")]
    table = spark.createDataFrame([*rows, *bad, rows[7]], "vec_id bigint, embedding array<float>, n string")
    asked = np.arange(0, 900, 20)
    want = neighbours.brute_force(np.arange(900), v.astype("f8"), asked, 20)
    for blocks in (neighbours.BLOCK_ROWS, 100):
        found = neighbours.nearest(table, table.filter("vec_id % 20 = 0"), block_rows=blocks, part_rows=100).collect()
        got: dict = {}
        for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
            got.setdefault(r.query_id, []).append((r.id, r.score))
        assert set(got) == set(asked.tolist()) and all(len(x) == 20 for x in got.values())
        recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
        assert recall >= 0.9 and got[300] == want[300]
    few = table.filter("vec_id < 3")
    assert neighbours.nearest(few, few).count() == 6
    assert neighbours.nearest(table.filter("false"), table).count() == 0


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="ad">Buy now this thing.</div><article><h1>A &amp; B</h1><p>First  one<br>goes on.<p>Second &eacute; <b>one.</b></article>
<section id="comments"><p>I think this is a nice text of yours.</p></section><footer>&copy; site</footer></body></html>"""


def test_extract(spark):
    pages = spark.createDataFrame([(1, PAGE, "t"), (2, None, ""), (3, "", ""), (4, "<p", ""), (5, PAGE, "")], "page_id int, html string, text string")
    field = extract.train(pages)
    out = {r.page_id: r.t for r in pages.select("page_id", extract.extract_text(spark, field, F.col("html")).alias("t")).collect()}
    assert out[1] == out[5] == "A & B\nFirst one goes on.\nSecond é one." and out[2] == out[3] == ""


def test_held_out_layouts():
    field = extract.fit([extract.blocks(p) for p in extract.labelled_pages([], 200, 1)])
    right = [b.keep == int(k) for p in extract.labelled_pages([], 100, 2) for f in [extract.blocks(p)] for b, k in zip(f, field.decode(f))]
    assert np.mean(right) > 0.97


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("allow", "good.com", "/")]


def test_urls(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">' for h in hosts)
    rows = [
        (1, "HTTP://Sub.Example.ORG/es/a?b", link("bad.net")), (2, "https://example.org", None), (3, None, ""), (4, "no url", ""),
        (5, "http://liar.net/", link("example.org")), (6, "http://good.com/", link("friend.net")), (7, "http://friend.net/p#q", ""), (7, "http://friend.net/p#q", ""),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id int, url string, html string, host string")
    out = {r.page_id: r.url_verdict for r in urls.judge_urls(pages, RULES).collect()}
    assert (out[1].host, out[1].path, out[1].rule, out[1].verdict) == ("sub.example.org", "/es/a", "example.org/es/", "block")
    assert (out[2].path, out[2].rule, out[2].verdict) == ("", None, "allow") and out[3].host == out[4].path == ""
    assert out[6].rule == "good.com/" and out[7].verdict == "allow" and out[7].trust > 0
    assert urls.judge_urls(pages.filter("false"), RULES).count() == 0


def test_distrust_goes_against_links(spark):
    rules = [("block", "bad.net", "/")]
    pages = spark.createDataFrame(
        [(1, "http://bad.net/", ""), (2, "http://liar.net/", '<a href="//bad.net">'), (3, "http://fine.net/", '<a href="/own">')], "page_id int, url string, html string"
    )
    out = {r.page_id: r.url_verdict.verdict for r in urls.judge_urls(pages, rules).collect()}
    assert out == {1: "block", 2: "block", 3: "allow"}


@pytest.fixture(scope="module")
def folder():
    return "/root/testdata/sf0.001"


def test_pipeline(spark, folder):
    """Every stage on the output of the one before: decisions take effect, columns stay."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    extra = docs.limit(1).withColumns({"text": F.lit(None).cast("string")}).unionByName(docs.limit(2)).unionByName(docs)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, extra, folder)
        rows = out.collect()
        assert out.columns[: len(columns)] == columns
        if name == "simhash_near_dedup":
            texts = [(r.doc_id, r.text) for r in extra.select("doc_id", "text").distinct().collect()]
            brute = simhash.brute_force([t for _, t in texts], [i for i, _ in texts])
            assert sorted(r.doc_id for r in rows) == sorted(set(brute.component_id))
        if name == "benchmark_decontamination":
            items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            held = extra.collect()
            brute = decontaminate.brute_force([r.text for r in held], items)
            bad = (brute.n_hit > 0) & (20 * brute.n_hit >= brute.n_words)
            assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r, b in zip(held, bad) if not b)
        extra = spark.createDataFrame(rows, out.schema)
    assert extra.filter("n_tokens is null or n_tokens < 0").filter("text is not null").count() == 0
    assert stage(spark, docs.filter("false"), folder).count() == 0
