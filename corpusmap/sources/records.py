"""Bringing records, vectors, files and exports into DataFrames."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# Column names that table conversions make up.
_GENERATED = re.compile(r"__index_level_\d+__")


def ingest(spark: SparkSession, data, schema=None) -> DataFrame:
    """A DataFrame from a Spark or pandas DataFrame, an Arrow table or a list of dicts."""
    if isinstance(data, DataFrame):
        return drop_generated(data)
    if isinstance(data, pa.Table):
        return drop_generated(spark.createDataFrame(data, schema=schema))
    if isinstance(data, pd.DataFrame):
        named = [c for c in data.columns if str(c).startswith("_") and c not in ("_embeddings", "_blob_hash")]
        if named:
            raise ValueError(f"names with a leading underscore are reserved: {named}")
        return spark.createDataFrame(pa.Table.from_pandas(data, preserve_index=False), schema=schema)
    if isinstance(data, list) and all(isinstance(r, dict) for r in data):
        return spark.createDataFrame(pa.Table.from_pylist(data), schema=schema)
    raise TypeError(f"cannot ingest {type(data).__name__}")


def ingest_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON-lines records with a declared schema, so nothing is read twice."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def drop_generated(df: DataFrame) -> DataFrame:
    """Without columns that a table conversion made up."""
    return df.drop(*[c for c in df.columns if _GENERATED.fullmatch(c)])


def attach_vectors(rows: DataFrame, vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows with their vector as ``_embeddings``, matched by id."""
    v = vectors.select(F.col(id_col), F.col(vector_col).alias("_embeddings"))
    return rows.join(v, id_col, "left")


def unmatched(rows: DataFrame, vectors: DataFrame, id_col: str) -> DataFrame:
    """Ids that only one side of ``attach_vectors`` has: ``id, side``."""
    a = rows.join(vectors, id_col, "left_anti").select(id_col, F.lit("no vector").alias("side"))
    b = vectors.join(rows, id_col, "left_anti").select(id_col, F.lit("no row").alias("side"))
    return a.unionByName(b)


def blob_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files as ``path, length, content, _blob_hash``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", "content", blob_hash(F.col("content")).alias("_blob_hash"))


def blob_hash(content):
    return F.sha2(content.cast("binary"), 256)


def attach_blobs(rows: DataFrame, blobs: DataFrame, key: str) -> DataFrame:
    """Rows with the hash of their blob; null where none was stored."""
    return rows.join(blobs.select(key, "_blob_hash"), key, "left")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Header-less text files as ``ordinal, text``; ordinals sort by file, then by place in it."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    return spark.read.text(path).select(place.alias("ordinal"), F.col("value").alias("text"))


def keyset_page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """The next page behind a cursor."""
    rest = df if after is None else df.filter(F.col(key) > F.lit(after))
    return rest.orderBy(key).limit(size)


def keyset_pages(df: DataFrame, key: str, size: int) -> Iterator[DataFrame]:
    """Pages in key order until one comes back empty. For a whole export, scan it instead."""
    after = None
    while True:
        page = keyset_page(df, key, after, size)
        last = page.agg(F.max(key)).first()[0]
        if last is None:
            return
        yield page
        after = last


def split_export(
    df: DataFrame, id_col: str, vector_col: str, exclude: tuple[str, ...] = (), text_only: bool = True
) -> tuple[DataFrame, DataFrame]:
    """A vector-store export as (properties, vectors), both keyed by id."""
    kept = [
        f.name
        for f in df.schema.fields
        if f.name not in (id_col, vector_col, *exclude)
        and (not text_only or f.dataType.typeName() == "string")
    ]
    return df.select(id_col, *kept), df.select(id_col, vector_col)
