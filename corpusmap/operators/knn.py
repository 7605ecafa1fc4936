"""Nearest-neighbour search: few queries over a whole corpus, and joins of two large sides."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusmap.functions import blocks
from corpusmap.operators import cells

# Fixed value: the largest k of a search.
MAX_K = 128
# So many queries, as one matrix, may travel to every task; more are joined cell by cell.
SCAN_QUERIES = 2048
SCAN_ROWS = 2048
# Copies of one vector, as a multiple of k, from which on only those of the smallest ids are searched.
MANY_COPIES = 4


def _check(k: int, metric: str) -> None:
    if not 1 <= k <= MAX_K:
        raise ValueError(f"k must be between 1 and {MAX_K}")
    if metric not in blocks.METRICS:
        raise ValueError(f"metric must be one of {blocks.METRICS}")


def rank_neighbors(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query, with rank from 1; ties go to the smaller id."""
    nearest = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return (
        candidates.withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("query_id", "neighbor_id", "distance", "rank")
    )


def search_by_vector(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 5,
    *,
    id_col: str = "id",
    vector_col: str = "vector",
    query_id_col: str = "id",
    query_vector_col: str = "vector",
    metric: str = "l2",
) -> DataFrame:
    """k nearest corpus rows of each query: ``query_id, neighbor_id, distance, rank``.

    Up to ``SCAN_QUERIES`` queries go to every task and the corpus is scanned once, each task
    keeping its own k best. More queries than that are joined cell by cell; for ``dot``, which has
    no cells, blocks of queries meet blocks of rows, and a block hands on k rows per query.
    """
    _check(k, metric)
    wanted = queries.select(
        F.col(query_id_col).alias("query_id"), F.col(query_vector_col).alias("vector")
    )
    rows = wanted.limit(SCAN_QUERIES + 1).toArrow()
    points = corpus.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    if rows.num_rows > SCAN_QUERIES:
        asked = wanted.withColumnRenamed("query_id", "id")
        if metric == "dot":
            one = [cells.settle(cells.dealt_into_one(side, metric)) for side in (asked, points)]
            return rank_neighbors(cells.block_search(*one, "cell", k, metric), k)
        return join_nearest(asked, points, k, metric=metric)
    query_type = wanted.schema["query_id"].dataType.simpleString()
    id_type = points.schema["id"].dataType.simpleString()
    query_ids = rows.column("query_id").combine_chunks()
    q = blocks.prepare(blocks.matrix(rows.column("vector")), metric)

    def scan(batches):
        best = None
        pieces = (b.slice(i, SCAN_ROWS) for b in batches for i in range(0, b.num_rows, SCAN_ROWS))
        for batch in pieces:
            if not len(q):
                continue
            x = blocks.prepare(blocks.matrix(batch.column(1)), metric)
            at, col, distance = blocks.nearest_in_block(q, x, k, metric, blocks.order_key(batch.column(0)))
            found = pa.table(
                {"query": at, "id": batch.column(0).take(pa.array(col)), "distance": distance}
            )
            best = found if best is None else pa.concat_tables([best, found])
            keep = blocks.keep_nearest(
                best["query"].to_numpy(), best["distance"].to_numpy(), blocks.order_key(best["id"]), k
            )
            best = best.take(pa.array(keep)).combine_chunks()
        if best is not None:
            out = pa.table(
                {
                    "query_id": query_ids.take(best["query"].combine_chunks()),
                    "neighbor_id": best["id"],
                    "distance": best["distance"],
                }
            )
            yield from out.to_batches()

    candidates = points.mapInArrow(
        scan, f"query_id {query_type}, neighbor_id {id_type}, distance double"
    )
    return rank_neighbors(candidates, k)


def search_by_id(
    corpus: DataFrame,
    ids: DataFrame,
    k: int = 5,
    *,
    id_col: str = "id",
    vector_col: str = "vector",
    metric: str = "l2",
    include_self: bool = True,
) -> DataFrame:
    """k nearest rows of rows named by id (``ids`` has the id column)."""
    _check(k if include_self else k + 1, metric)
    queries = corpus.join(ids.select(id_col).distinct(), id_col, "left_semi")
    found = search_by_vector(
        corpus,
        queries,
        k if include_self else k + 1,
        id_col=id_col,
        vector_col=vector_col,
        query_id_col=id_col,
        query_vector_col=vector_col,
        metric=metric,
    )
    if include_self:
        return found
    others = found.filter(F.col("query_id") != F.col("neighbor_id")).drop("rank")
    return rank_neighbors(others, k)


def neighbor_rows(found: DataFrame, rows: DataFrame, id_col: str = "id") -> DataFrame:
    """Search results joined to the full rows of the neighbours."""
    return found.join(rows.withColumnRenamed(id_col, "neighbor_id"), "neighbor_id")


def similar_rows(
    rows: DataFrame, query: list[float], threshold: float, *, vector_col: str = "vector"
) -> DataFrame:
    """Rows whose dot product with one query vector exceeds a threshold, with the ``similarity``."""
    parts = F.array(*[F.lit(float(x)) for x in query])
    product = F.aggregate(
        F.zip_with(F.col(vector_col).cast("array<double>"), parts, lambda x, y: x * y),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    return rows.withColumn("similarity", product).filter(F.col("similarity") > threshold)


def few_copies(rows: DataFrame, k: int) -> DataFrame:
    """Of the copies of a vector that has very many, those of the k smallest ids: no others are among k nearest rows."""
    most = rows.groupBy(F.xxhash64("vector").alias("mark")).count().agg(F.max("count").alias("most")).first()["most"]
    if (most or 0) <= MANY_COPIES * k:
        return rows
    turn = Window.partitionBy("vector").orderBy(F.asc_nulls_last("id"))
    return cells.settle(rows.withColumn("turn", F.dense_rank().over(turn)).filter(F.col("turn") <= k).drop("turn"))


def join_nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    *,
    metric: str = "l2",
    probes: int = 4,
    complete: bool = True,
    exclude_self: bool = False,
    pivots: int | None = None,
    cell_rows: int = cells.CELL_ROWS,
) -> DataFrame:
    """k nearest corpus rows of every row of a large query side (columns ``id, vector`` on both).

    The corpus is cut into cells of about ``cell_rows`` rows (or about ``pivots`` cells) around pivots of two levels. Each
    query first looks into its ``probes`` nearest cells, which bounds its k-th distance. With ``complete`` (default) it then
    visits every other cell that the bound cannot rule out at both levels, so the result is exact; without it the answer is the
    usual approximate one.
    """
    _check(k, metric)
    if metric == "dot":
        raise ValueError("cells need a metric space: use l2, cosine or hamming")
    corpus = few_copies(corpus.select("id", "vector"), k + exclude_self)
    index = cells.Cells.over(corpus, metric, pivots, cell_rows)
    near = cells.search_cells(index.nearest_cells(queries, probes), index.homes, k, metric, exclude_self)
    if complete:
        near = cells.settle(rank_neighbors(near, k))
        bounds = near.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("distance").alias("bound"))
        far, whole = index.search_within(cells.settle(queries.select("id", "vector").join(bounds, "id", "left")), k, probes, exclude_self)
        near = far if whole else near.drop("rank").unionByName(far)
    found = cells.settle(rank_neighbors(near, k))
    index.discard()
    return found


def neighbor_graph(
    points: DataFrame, k: int = 15, *, metric: str = "l2", complete: bool = True, cell_rows: int = cells.CELL_ROWS
) -> DataFrame:
    """The k nearest other rows of every row."""
    return join_nearest(points, points, k, metric=metric, complete=complete, exclude_self=True, cell_rows=cell_rows)


def topic_posterior(found: DataFrame, topics: DataFrame, id_col: str, topic_col: str) -> DataFrame:
    """Share of each topic among a query's neighbours: ``query_id, topic, probability``."""
    votes = found.join(
        topics.select(F.col(id_col).alias("neighbor_id"), F.col(topic_col).alias("topic")), "neighbor_id"
    )
    counts = votes.groupBy("query_id", "topic").agg(F.count(F.lit(1)).alias("n"))
    size = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("k"))
    return counts.join(size, "query_id").select(
        "query_id", "topic", (F.col("n") / F.col("k")).alias("probability")
    )


def most_likely_topic(posterior: DataFrame) -> DataFrame:
    """The topic with the highest probability of each query; ties go to the smaller topic."""
    best = F.min_by(
        F.struct("topic", "probability"), F.struct(-F.col("probability"), F.col("topic"))
    )
    return posterior.groupBy("query_id").agg(best.alias("best")).select("query_id", "best.*")


def place_new_points(found: DataFrame, positions: DataFrame) -> DataFrame:
    """New rows on an existing map: mean position of their neighbours (``id, x, y``)."""
    located = found.join(positions.withColumnRenamed("id", "neighbor_id"), "neighbor_id")
    return located.groupBy(F.col("query_id").alias("id")).agg(
        F.avg("x").alias("x"), F.avg("y").alias("y")
    )
