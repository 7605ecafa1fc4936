"""Text embedding: feature hashing by default, any Arrow or pandas UDF as a plug-in."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusmap.functions import text, vectors
from corpusmap.session import spread

# Embedding tasks, and how to treat long texts.
TASK_TYPES = ("search_query", "search_document", "classification", "clustering")
LONG_TEXT_MODES = ("truncate", "mean")
# How many tokens a piece has where long texts are embedded piece by piece.
PIECE_TOKENS = 8192
# What an empty text is embedded as, so that every row has a vector.
EMPTY_TEXT = "empty text"

Embedder = Callable[[Column], Column]


# Tokens that are counted at once, so that long texts do not pile up in memory.
_TOKENS_AT_ONCE = 1 << 18


def _hashed(hashes: pa.ListArray, dims: int, chunk: int | None) -> pa.ListArray:
    """Vectors of a batch, worked out a bounded number of tokens at a time."""
    lengths = np.asarray(hashes.value_lengths().fill_null(0))
    group = np.cumsum(lengths) // _TOKENS_AT_ONCE
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(lengths)]
    parts = [_hash_rows(hashes.slice(a, b - a), dims, chunk) for a, b in zip(edges, edges[1:])]
    out = np.concatenate(parts) if parts else np.zeros((0, dims))
    offsets = pa.array(np.arange(len(lengths) + 1) * dims, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))


def _hash_rows(hashes: pa.ListArray, dims: int, chunk: int | None) -> np.ndarray:
    """Signed feature hashing with log counts; rows of several chunks are averaged."""
    lengths = np.asarray(hashes.value_lengths().fill_null(0)).astype(np.int64)
    values = hashes.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    piece = (np.arange(len(values)) - starts) // chunk if chunk else np.zeros(len(values), np.int64)
    pieces = np.maximum(1, -(-lengths // chunk)) if chunk else np.ones(len(lengths), np.int64)
    unit = (np.cumsum(pieces) - pieces)[row] + piece
    # Count every token of every chunk: tokens are 32 bits wide, so both fit one key.
    key, counts = np.unique((unit << 32) | values, return_counts=True)
    unit, token = key >> 32, key & 0xFFFFFFFF
    weight = (1.0 + np.log(counts)) * np.where((token // dims) % 2 == 0, 1.0, -1.0)
    flat = np.bincount(unit * dims + token % dims, weight, minlength=int(pieces.sum()) * dims)
    per_unit = _unit_rows(flat.reshape(-1, dims))
    owner = np.repeat(np.arange(len(lengths)), pieces)
    out = np.zeros((len(lengths), dims))
    np.add.at(out, owner, per_unit)
    return _unit_rows(out / pieces[:, None])


def _unit_rows(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def hash_embedder(
    dims: int = 256, long_text_mode: str = "truncate", max_tokens: int | None = None
) -> Embedder:
    """Embedder whose tokens are split and hashed in the JVM; only whole numbers reach Python.

    Whole texts count unless ``max_tokens`` is given: with ``truncate`` it cuts them, with ``mean`` it
    is the length of the pieces whose vectors are averaged (``PIECE_TOKENS`` by default).
    """
    if long_text_mode not in LONG_TEXT_MODES:
        raise ValueError(f"long_text_mode must be one of {LONG_TEXT_MODES}")
    chunk = (max_tokens or PIECE_TOKENS) if long_text_mode == "mean" else None

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def embed(hashes: pa.Array) -> pa.Array:
        return _hashed(hashes, dims, chunk)

    def apply(c: Column) -> Column:
        words = text.tokens(c)
        if chunk is None and max_tokens is not None:
            words = F.slice(words, 1, max_tokens)
        return embed(F.transform(words, text.token_hash))

    return apply


def prefixed(c: Column, task_type: str) -> Column:
    """The text with its task in front."""
    if task_type not in TASK_TYPES:
        raise ValueError(f"task_type must be one of {TASK_TYPES}")
    filled = F.when(c.isNull() | (c == ""), F.lit(EMPTY_TEXT)).otherwise(c)
    return F.concat(F.lit(f"{task_type}: "), filled)


def embed_text(
    df: DataFrame,
    text_col: str = "text",
    *,
    embedder: Embedder | None = None,
    task_type: str = "search_document",
    dims: int | None = None,
    output: str = "_embeddings",
) -> DataFrame:
    """Add a vector per text. ``dims`` cuts the vectors of an embedder to their first components."""
    if isinstance(df, str):
        raise TypeError("embed a table of texts, not a string")
    v = (embedder or hash_embedder())(prefixed(F.col(text_col), task_type))
    out = spread(df).withColumn(output, v)
    return out if dims is None else out.withColumn(output, vectors.truncate_dims(F.col(output), dims))


def char_chunks(df: DataFrame, text_col: str, size: int) -> DataFrame:
    """One row per run of ``size`` characters: the columns plus ``chunk`` (from 0), text replaced."""
    c = F.col(text_col)
    last = F.greatest(F.ceil(F.char_length(c) / F.lit(size)) - 1, F.lit(0)).cast("int")
    return df.withColumn("chunk", F.explode(F.sequence(F.lit(0), last))).withColumn(
        text_col, F.substring(c, F.col("chunk") * size + 1, F.lit(size))
    )


def pool_chunks(chunks: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Unit-length mean of the unit-length chunk vectors of each id, combined map-side first."""
    unit = array_to_vector(vectors.normalize(F.col(vector_col)))
    pooled = chunks.groupBy(id_col).agg(vector_to_array(Summarizer.mean(unit)).alias(vector_col))
    return pooled.withColumn(vector_col, vectors.normalize(F.col(vector_col)))


def text_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def reuse_split(rows: DataFrame, earlier: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows that keep an earlier vector, rows to embed). ``earlier``: id, ``text_hash``, vector."""
    hashed = rows.withColumn("text_hash", text_hash(F.col(text_col)))
    key = [id_col, "text_hash"]
    return hashed.join(earlier, key), hashed.join(earlier, key, "left_anti")


def embed_lines(lines: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Batch embedding of ``ordinal, text`` lines. A first line ``dim, bool`` sets the options."""
    settings = F.regexp_extract("text", r"^\s*(\d+)\s*,\s*([Tt]rue|[Ff]alse)\s*$", 0) != ""
    first = lines.orderBy("ordinal").limit(1).filter(settings).first()
    dims, binary = None, False
    if first is not None:
        number, flag = first["text"].split(",")
        dims, binary = int(number), flag.strip().lower() == "true"
        lines = lines.filter(F.col("ordinal.line") != first["ordinal"]["line"])
    out = embed_text(lines, "text", embedder=embedder, dims=dims, output="embedding")
    if binary:
        out = out.withColumn("embedding", F.transform(vectors.binarize(F.col("embedding")), lambda b: b.cast("double")))
    return out


def image_source(c: Column) -> Column:
    """``url`` for web addresses, ``file`` for anything else; one request must not mix them."""
    return F.when(F.lower(c).rlike(r"^https?://[^/?#]+"), "url").otherwise("file")


def embed_images(df: DataFrame, ref_col: str, embedder: Embedder, output: str = "_embeddings") -> DataFrame:
    """Vectors of images named by address or by file, by an image embedder; never both kinds at once."""
    kinds = df.agg(F.collect_set(image_source(F.col(ref_col))).alias("kinds")).first()["kinds"]
    if len(kinds) > 1:
        raise ValueError("give either web addresses or files, not both")
    return spread(df).withColumn(output, embedder(F.col(ref_col)))
