import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from corpusmap.functions import text, times, vectors
from corpusmap.operators import checks, rows, schema
from corpusmap.sources import records


def test_type_map(spark):
    df = spark.sql(
        "SELECT 1Y AS b, 2L AS l, 1.5D AS d, 'x' AS s, DATE '2020-01-02' AS day, "
        "TIMESTAMP_NTZ '1950-01-01 00:00:00.123456' AS t"
    )
    out = schema.coerce(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "int", "int", "float", "string", "timestamp_ntz", "timestamp_ntz",
    ]
    assert out.first()["t"] == dt.datetime(1950, 1, 1, 0, 0, 0, 123000)


@pytest.mark.parametrize(
    "expression", ["true", "array(1)", "struct(1 AS a)", "map('a', 1)", "CAST(1 AS DECIMAL(5,2))", "CAST('a' AS BINARY)"]
)
def test_unsupported_types(spark, expression):
    with pytest.raises(schema.SchemaError):
        schema.coerce(spark.sql(f"SELECT {expression} AS c"))


@pytest.mark.parametrize(
    "names, modality, id_field, rule",
    [
        (["__hello"], "text", None, "reserved name"),
        (["a", "A"], "text", None, "same name ignoring case"),
        (["a", "_embeddings"], "text", None, "text data with vectors"),
        (["a"], "embedding", None, "no vectors"),
        (["a"], "image", None, "no blobs"),
        (["a"], "text", "id", "missing id"),
        (["a"], "sound", None, "unknown modality"),
    ],
)
def test_name_rules(names, modality, id_field, rule):
    found = schema.name_problems(T.StructType([T.StructField(n, T.StringType()) for n in names]), modality, id_field)
    assert rule in [r for r, _ in found]


def test_conform(spark):
    target = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("a", T.FloatType())])
    df = spark.createDataFrame([(1.5, 3_000_000_000, "x"), (2.0, -1, "y")], "a double, b bigint, extra string")
    assert [tuple(r) for r in schema.conform(df, target).collect()] == [(-1294967296, 1.5), (-1, 2.0)]
    with pytest.raises(schema.SchemaError, match="missing column"):
        schema.conform(df.drop("b"), target)


def test_fraction_to_int_is_cut(spark):
    target = T.StructType([T.StructField("a", T.IntegerType())])
    df = spark.createDataFrame([(1.9,), (-1.9,), (float("nan"),), (1e300,)], "a double")
    assert [r.a for r in schema.conform(df, target).collect()] == [1, -1, None, None]


def test_null_strings(spark):
    df = spark.createDataFrame([(None, ""), ("x", "y")], "id string, t string")
    assert [tuple(r) for r in schema.fill_null_strings(df).collect()] == [("null", "null"), ("x", "y")]
    assert schema.fill_null_strings(df, "id").first()["id"] is None


def test_ids(spark):
    df = spark.createDataFrame([(None,), ("a" * 100,), ("ok",), ("b" * 36,)], "id string")
    assert {r.rule: r.n for r in checks.validate_ids(df, "id").collect()} == {"null id": 1, "id too long": 1}
    with pytest.raises(checks.RowError, match="null id in id: 1"):
        checks.enforce(checks.validate_ids(df, "id"))


def test_vector_rules(spark):
    rows_ = [([1.0, 2.0],), ([float("nan"), 1.0],), ([float("inf"), 0.0],), ([1.0],), (None,), ([65520.0, 0.0],), ([65519.0, 0.0],)]
    df = spark.createDataFrame(rows_, "v array<double>")
    assert {r.rule: r.n for r in checks.validate_vectors(df, "v", half=True).collect()} == {
        "no rows": 0, "null vector": 1, "lengths differ": 1, "invalid component": 2, "half overflow": 2,
    }
    empty = checks.validate_vectors(df.filter("false"), "v")
    assert {r.rule: r.n for r in empty.collect()}["no rows"] == 1


def test_half_rounding(spark):
    rng = np.random.default_rng(1)
    values = np.float32([0.1, 65519.0, 65520.0, -7e4, -2.000001, 1e-8, 3e-8, 0.0, 6.1e-5, 2049.0, 2051.0, 1.0])
    values = np.concatenate([values, (rng.normal(size=500) * 10.0 ** rng.integers(-9, 5, 500)).astype(np.float32)])
    df = spark.createDataFrame([([float(x) for x in values],)], "v array<float>")
    got = df.select(vectors.quantize_half(F.col("v")).alias("h")).first()["h"]
    with np.errstate(over="ignore"):
        assert got == [float(x) for x in values.astype(np.float16)]


def test_categories(spark):
    df = spark.createDataFrame(
        [(i, i % 3, f"u{i}", None if i == 0 else f"v{i % 10}", f"t{i % 2}") for i in range(40)],
        "id int, n int, label string, eleven string, two string",
    )
    found = {r.field: (r.few_values, r.color) for r in checks.infer_color_fields(df).collect()}
    assert found == {"n": (True, True), "label": (False, True), "eleven": (False, False), "two": (True, True)}
    assert dict(checks.stringify_few_valued(df).dtypes)["n"] == "string"


def test_unbatch(spark):
    df = spark.createDataFrame([([[1.0], [2.0]], ["a", "b"], 7)], "v array<array<double>>, c array<string>, step int")
    assert [tuple(r) for r in checks.unbatch(df, "v", ["c"]).collect()] == [(7, [1.0], "a"), (7, [2.0], "b")]
    one = spark.createDataFrame([([[1.0]], "a")], "v array<array<double>>, c string")
    assert [tuple(r) for r in checks.unbatch(one, "v", ["c"]).collect()] == [([1.0], "a")]
    bad = spark.createDataFrame([([[1.0]], ["a", "b"])], "v array<array<double>>, c array<string>")
    with pytest.raises(Exception, match="differ in number"):
        checks.unbatch(bad, "v", ["c"]).collect()


def test_slugs(spark):
    names = ["Me/My Dataset_1", "Me/Crème  Brûlée!!", "Plain Name", "a/b/c", "X/İstanbul", "X/K"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(text.slug_identifier(F.col("n"))).collect()]
    assert got == ["Me/my-dataset-1", "Me/creme-brulee", "plain-name", "a/bc", "X/istanbul", "X/k"]
    assert [r[0] for r in df.select(text.is_identifier(F.col("n"))).collect()] == [True, True, False, False, True, True]


def test_compact_keys(spark):
    df = spark.createDataFrame([(0,), (832,), (255,), (2**40,)], "i bigint")
    assert [r[0] for r in df.select(text.compact_key(F.col("i"))).collect()] == ["AA", "A0A", "/w", "AQAAAAAA"]


def test_time_range_is_inclusive(spark):
    df = spark.sql("SELECT explode(array(TIMESTAMP_NTZ '2020-01-01', TIMESTAMP_NTZ '2020-01-02', TIMESTAMP_NTZ '2020-01-03')) AS t")
    assert df.filter(times.between(F.col("t"), "2020-01-01", "2020-01-02")).count() == 2


def test_ingest_kinds(spark):
    wanted = [(1, "a"), (2, "b")]
    pdf = pd.DataFrame({"n": [1, 2], "s": ["a", "b"]}, index=[5, 6])
    for data in (pdf, pa.Table.from_pandas(pdf), [{"n": 1, "s": "a"}, {"n": 2, "s": "b"}]):
        assert [tuple(r) for r in records.ingest(spark, data).collect()] == wanted
    with pytest.raises(TypeError):
        records.ingest(spark, "rows")
    with pytest.raises(ValueError):
        records.ingest(spark, pd.DataFrame({"_x": [1]}))


def test_paging_covers_all_rows(spark):
    df = spark.range(25)
    pages = [[r.id for r in p.collect()] for p in records.keyset_pages(df, "id", 10)]
    assert [len(p) for p in pages] == [10, 10, 5] and sum(pages, []) == list(range(25))


def test_point_reads(spark):
    df = spark.range(10)
    assert sorted(r.id for r in rows.by_ids(df, [3, 4, 99]).collect()) == [3, 4]
    assert rows.without_ids(df, [3, 4]).count() == 8
    with pytest.raises(ValueError):
        rows.by_ids(df, [[1]])
    with pytest.raises(TypeError):
        rows.by_ids(df, 1)
    assert rows.cap(df, -1).count() == 10 and rows.cap(df, 3).count() == 3
    assert rows.sample(df, 4, seed=1).collect() == rows.sample(df.repartition(3), 4, seed=1).collect()
    again = spark.createDataFrame([(1,), (11,), (11,)], "id bigint")
    assert [r.id for r in rows.new_rows(again, df).collect()] == [11]


def test_blobs(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"abc")
    (tmp_path / "b.txt").write_bytes(b"")
    files = records.blob_files(spark, str(tmp_path), "*.png").collect()
    assert len(files) == 1
    assert files[0]["_blob_hash"] == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_precision_recall_without_hits(spark):
    df = spark.createDataFrame([(False, False)], "p boolean, a boolean")
    got = rows.precision_recall(df, "p", "a").first()
    assert (got.tn, got.precision, got.recall) == (1, None, None)
