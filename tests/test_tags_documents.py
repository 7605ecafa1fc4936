import pytest
from pyspark.sql import functions as F, types as T

from corpusmap.operators import documents, tags


@pytest.fixture(scope="module")
def tagged(spark):
    return spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "gone")], "id int, tag string")


@pytest.fixture(scope="module")
def defined(spark):
    return spark.createDataFrame([("a", True), ("b", True), ("wip", False)], "tag string, complete boolean")


def test_tag_table(spark, tagged, defined):
    ids = spark.createDataFrame([(1,), (2,), (4,)], "id int")
    got = {r.id: (r.a, r.b) for r in tags.tag_table(ids, tagged, defined).collect()}
    assert got == {1: (True, False), 2: (True, True), 4: (False, False)}


def test_tag_lookup(spark, tagged, defined):
    assert tags.tag_by_name(defined, "a")["tag"] == "a"
    for name in ("wip", "none"):
        with pytest.raises(ValueError):
            tags.tag_by_name(defined, name)
    assert sorted(tuple(r) for r in tags.prune(tagged, defined).collect()) == [(1, "a"), (2, "a"), (2, "b")]


def test_tag_changes(spark, tagged):
    ids = spark.createDataFrame([(1,), (2,)], "id int")
    added = tags.add(tagged, ids, ["b", "c"])
    assert sorted(tuple(r) for r in added.collect()) == [
        (1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "b"), (2, "c"), (3, "gone"),
    ]
    assert tags.add(added, ids, ["b", "c"]).count() == added.count()
    assert sorted(tuple(r) for r in tags.remove(tagged, ids, ["a"]).collect()) == [(2, "b"), (3, "gone")]
    assert tags.remove(tagged, None, ["a", "b"], delete_all=True).count() == 1


def test_content_types(spark):
    files = [
        ("x.pdf", b"%PDF-1.7"), ("x.PNG", b"\x89PNG\r\n\x1a\n.."), ("x.DOCX", b"PK\x03\x04.."), ("x.zip", b"PK\x03\x04.."),
        ("x.webp", b"RIFF....WEBP"), ("x.txt", b"hello"), ("x", b""), ("x.xls", bytes.fromhex("D0CF11E0A1B11AE1")), ("x.tar", b"0" * 257 + b"ustar"),
    ]
    df = spark.createDataFrame(files, "path string, content binary")
    known, unknown = documents.detect_content_types(df)
    assert {r.path: r.content_type for r in known.collect()} == {
        "x.pdf": "application/pdf", "x.PNG": "image/png", "x.DOCX": documents.ZIP_OFFICE[".docx"],
        "x.webp": "image/webp", "x.tar": "application/x-tar", "x.xls": "application/vnd.ms-excel",
    }
    assert sorted(r.path for r in unknown.collect()) == ["x", "x.txt", "x.zip"]


def test_links(spark):
    urls = ["http://a", "HTTPS://a/b", "file:///tmp/x", "/tmp/x", "ftp://a", "doc.pdf", "store:1"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(documents.link_problem(F.col("u"), ("store",))).collect()]
    assert got == [None, None, "local file", "no scheme", "unsupported scheme", "no scheme", None]


PAGE = (
    "<html><head><title>A &amp; B</title><script>var t='<p>no</p>';</script></head><body><!-- <p>no</p> -->"
    "<h2 class='x'>Head</h2>loose<p>one<br>two <b>bold</b></p><ul><li>item</ul><table><tr><td>1</td><th>2</th></tr></table></body>"
)
BLOCKS = [
    ("title", None, "A & B"), ("heading", 2, "Head"), ("text", None, "loose"), ("p", None, "one two bold"),
    ("li", None, "item"), ("td", None, "1"), ("th", None, "2"),
]


def test_parse(spark):
    df = spark.createDataFrame([(1, PAGE)], "id int, html string")
    got = documents.block_rows(documents.parse_pages(df), "id").orderBy("position").collect()
    assert [(r.kind, r.level, r.text) for r in got] == BLOCKS


def test_character_references(spark):
    texts = ["a &amp; b &lt; c", "&eacute;&copy 1&notit;&#233;&#x1F600;&#xD800;", "&&nope; &;&#;", "&AMP;amp;", "", None, "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(documents.decode_references(F.col("t"))).collect()]
    assert got == ["a & b < c", "é© 1¬it;é😀\ufffd", "&&nope; &;&#;", "&amp;", "", None, "plain"]


def test_parse_modes(spark):
    df = spark.createDataFrame([(1, PAGE)], "id int, html string")
    with pytest.raises(NotImplementedError):
        documents.parse_pages(df, mode="ocr")
    with pytest.raises(ValueError):
        documents.parse_pages(df, mode="fast")


def test_extract(spark):
    parcel = {
        "type": "object",
        "properties": {
            "sealed": {"type": "boolean"},
            "grams": {"type": ["null", "number"]},
            "stamps": {"type": "array", "items": {"type": "integer"}},
            "to": {"type": "object", "properties": {"city": {"type": "string"}}},
        },
    }
    texts = ['{"sealed": false, "grams": 2.5, "stamps": [7, 9], "to": {"city": "Ulm"}}', '{"stamps": []}', "torn label"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string")
    got = {r.id: r.result for r in documents.extract_json(df, "j", parcel).collect()}
    assert got[0].asDict(recursive=True) == {"sealed": False, "grams": 2.5, "stamps": [7, 9], "to": {"city": "Ulm"}}
    assert tuple(got[1]) == (None, None, [], None)
    assert got[2] is None or not any(got[2])


@pytest.mark.parametrize(
    "schema", [{}, {"type": "array"}, {"type": "object"}, {"type": "date"}, [], {"type": "object", "properties": {"a": {"type": "string"}}, "required": ["b"]}]
)
def test_bad_schemas(schema):
    with pytest.raises(ValueError):
        documents.json_schema_type(schema)


def test_schema_types():
    assert documents.json_schema_type({"type": "number"}) == T.DoubleType()
