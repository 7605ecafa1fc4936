"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a sample is cut into parts of equal size that few of its edges cross. A small
network learns, for a vector, how its neighbours spread over the parts; every row goes to its
likeliest part, and a query visits parts from the likeliest on until they should hold a set share of
its neighbours. Rows of the visited parts are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from corpusmap.operators.rows import hash_order, smallest
from corpusmap.session import cut_lineage, discard

#: Bound of the sample that graph and network are fitted on, and of the number of parts.
SAMPLE, MOST_PARTS = 16384, 512
PART_ROWS, BLOCK_ROWS, GRAPH_K, HIDDEN = 2048, 8192, 10, 64
MASS = 0.98


def neighbour_graph(vectors: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows of largest inner product for each row, itself excluded."""
    k = min(k, len(vectors) - 1)
    out = np.zeros((len(vectors), k), "i8")
    for i in range(0, len(vectors), 1024):
        scores = vectors[i : i + 1024] @ vectors.T
        scores[np.arange(len(scores)), np.arange(i, i + len(scores))] = -np.inf
        out[i : i + 1024] = np.argpartition(-scores, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 15, slack: float = 1.15) -> np.ndarray:
    """Parts of about equal size with few edges between them.

    Median cuts along main directions give equal parts; then nodes move to the part where most of their
    neighbours are, the most eager first, as long as that part has room.
    """
    label, pieces = np.zeros(len(vectors), "i8"), [np.arange(len(vectors))]
    while len(pieces) < parts:
        pieces.sort(key=len)
        rows = pieces.pop()
        centred = vectors[rows] - vectors[rows].mean(axis=0)
        axis = np.linalg.svd(centred[: 1 << 11], full_matrices=False)[2][0]
        order = rows[np.argsort(centred @ axis, kind="stable")]
        pieces += [order[: len(order) // 2], order[len(order) // 2 :]]
    for number, rows in enumerate(pieces):
        label[rows] = number
    room = int(np.ceil(slack * len(vectors) / parts))
    size, rows = np.bincount(label, minlength=parts), np.arange(len(vectors))
    for _ in range(rounds):
        votes = np.zeros((len(vectors), parts), "i4")
        for column in graph.T:
            np.add.at(votes, (rows, label[column]), 1)
            np.add.at(votes, (column, label), 1)
        best = votes.argmax(axis=1)
        gain = votes[rows, best] - votes[rows, label]
        moved = 0
        for i in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            if size[best[i]] < room:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


@dataclass
class Router:
    """One hidden layer and a softmax over parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def shares(self, vectors: np.ndarray) -> np.ndarray:
        """How the neighbours of each vector should spread over the parts. The length of a vector does not matter."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        out = np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


def fit_router(vectors: np.ndarray, graph: np.ndarray, label: np.ndarray, parts: int, epochs: int = 30, rate: float = 0.01, seed: int = 0) -> Router:
    """Cross-entropy between the network's shares and the parts of each row's neighbours and its own, by Adam."""
    random = np.random.default_rng(seed)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    held = np.concatenate([label[:, None], label[graph]], axis=1)
    shape = (vectors.shape[1], HIDDEN)
    weights = [random.normal(0, shape[0] ** -0.5, shape), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, (HIDDEN, parts)), np.zeros(parts)]
    m, v, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        for rows in np.array_split(random.permutation(len(unit)), max(1, len(unit) // 256)):
            x = unit[rows]
            target = np.zeros((len(rows), parts))
            np.add.at(target, (np.arange(len(rows))[:, None], held[rows]), 1 / held.shape[1])
            hidden = np.maximum(x @ weights[0] + weights[1], 0)
            out = hidden @ weights[2] + weights[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            error = (out / out.sum(axis=1, keepdims=True) - target) / len(rows)
            back = (error @ weights[2].T) * (hidden > 0)
            grads, step = [x.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)], step + 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                lr = rate * (1 - epoch / epochs)
                weights[i] = weights[i] - lr * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Router(*weights)


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as rows of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype("f8")
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` of the vectors that take part, each pair once."""
    held = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    held = held.filter(
        "id is not null and v is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)"
    )
    widths = held.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(2).collect()
    return held.filter(F.size("v") == widths[0].n) if len(widths) > 1 else held


def best_of(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, id and score of the ``k`` largest inner products, ties to the smaller id.

    Scores below a query's ``floor`` are left out.

    The matrix product only makes a shortlist, with room for its rounding; scores are summed anew in an
    order that depends on nothing else, so equal vectors get equal scores.
    """
    out_q, out_id, out_s = [], [], []
    floor = np.full(len(queries), -np.inf) if floor is None else floor
    limit = np.abs(rows).sum(axis=1).max() * 1e-12 if len(rows) else 0.0
    for i in range(0, len(queries), 256):
        block = queries[i : i + 256]
        scores = block @ rows.T
        scores[own[i : i + 256, None] == ids[None, :]] = -np.inf
        if len(rows) > k:
            kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        else:
            kth = np.full(len(block), -np.inf)
        kth = np.maximum(kth, floor[i : i + 256])
        margin = limit * np.abs(block).max(axis=1)
        q, c = np.nonzero((scores >= (kth - margin)[:, None]) & np.isfinite(scores))
        exact = np.zeros(len(q))
        for j in range(0, len(q), 1 << 16):
            exact[j : j + (1 << 16)] = (block[q[j : j + (1 << 16)]] * rows[c[j : j + (1 << 16)]]).sum(axis=1)
        order = np.lexsort((ids[c], -exact, q))
        q, c, exact = q[order], c[order], exact[order]
        head = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, "i8")
        nth = np.arange(len(q)) - np.repeat(head, np.diff(np.append(head, len(q))))
        keep = (nth < k) & (exact >= floor[q + i])
        out_q.append(q[keep] + i)
        out_id.append(ids[c[keep]])
        out_s.append(exact[keep])
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_s)


def fit_index(rows: DataFrame, count: int, sample: int = SAMPLE, part_rows: int = PART_ROWS, most_parts: int = MOST_PARTS) -> Router:
    """A router for ``count`` distinct vectors ``id, v``, fitted on at most ``sample`` of them, drawn by hash."""
    drawn = smallest(rows.select("id", "v"), sample, hash_order("v", "id")).toArrow().sort_by("id")
    vectors = matrix(drawn.column("v").combine_chunks())
    parts = int(min(max(1, -(-count // part_rows)), most_parts, max(1, len(vectors) // 16)))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = neighbour_graph(unit, GRAPH_K)
    return fit_router(vectors, graph, balanced_parts(unit, graph, parts), parts)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", mass: float = MASS,
    block_rows: int = BLOCK_ROWS, **index,
) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` rows of ``vectors`` found nearest each row of ``queries`` by inner product.

    A query never finds rows with its own id. Ties go to the smaller id. Vectors that are null, empty, zero or hold
    null or non-finite components, rows without an id and vectors of another length than most take no part;
    repeated rows count once. Of equal vectors only the ``k + 1`` smallest ids can be found, so only those are kept.
    A query with fewer than ``k`` candidates in the visited parts visits all.

    A query's likeliest part is scored first; from the others only rows that reach its k-th score are handed on.
    Parts of more than ``block_rows`` rows or queries are scored block by block, each pair of blocks in its own task.
    """
    spark = vectors.sparkSession
    all_rows = usable(vectors, id_col, vector_col)
    same = Window.partitionBy("v").orderBy("id")
    rows = all_rows.distinct().withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1)
    rows = cut_lineage(rows)
    first = rows.filter("nth = 1")
    count = first.count()
    if not count:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score double")
    router = fit_index(first.select("id", "v"), count, **index)
    held, parts = spark.sparkContext.broadcast(router), len(router.b2)

    @arrow_udf("int")
    def home(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(held.value.shares(matrix(batch)).argmax(axis=1) if len(batch) else [], pa.int32())

    @arrow_udf("array<int>")
    def visits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            shares = held.value.shares(matrix(batch)) if len(batch) else np.zeros((0, parts))
            order = np.argsort(-shares, axis=1, kind="stable")
            upto = np.cumsum(np.take_along_axis(shares, order, axis=1), axis=1)
            need = np.minimum((upto < mass).sum(axis=1) + 1, parts)
            yield pa.array([o[:n].tolist() for o, n in zip(order, need)], pa.list_(pa.int32()))

    asked = usable(queries, id_col, vector_col).distinct().withColumnsRenamed({"id": "query_id", "v": "q"})
    indexed = cut_lineage(rows.select("id", "v", home("v").alias("part")))
    sizes = indexed.groupBy("part").count().withColumnRenamed("count", "n")
    seen = cut_lineage(asked.select("query_id", "q", visits("q").alias("parts")))
    first_part = F.col("parts")[0].alias("first_part")
    visiting = cut_lineage(seen.select("query_id", "q", first_part, F.explode("parts").alias("part")))

    # enough candidates: a visited part may be small
    reach = visiting.select("query_id", "part").join(F.broadcast(sizes), "part", "left").groupBy("query_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    short = reach.filter(F.col("n") <= k)
    more = (
        seen.join(short, "query_id", "left_semi")
        .select("query_id", "q", first_part, F.explode(F.array_except(F.sequence(F.lit(0), F.lit(parts - 1)), "parts")).alias("part"))
    )
    visiting = visiting.unionByName(more)

    def block(id_name: str, blocks: str):
        return F.pmod(F.xxhash64(id_name), F.col(blocks)).cast("int")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ("part", "rb", "qb")

    def score(table: pa.Table, asking: pa.Table) -> pa.Table:
        none = pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not table.num_rows or not asking.num_rows:
            return none
        ids, query_ids, floor = table.column("id").to_numpy(), asking.column("query_id").to_numpy(), asking.column("floor").to_numpy()
        q, found, scores = best_of(matrix(asking.column("q").combine_chunks()), matrix(table.column("v").combine_chunks()), ids, query_ids, k, floor)
        return pa.table({"query_id": query_ids[q], "id": found, "score": scores})

    def scored(asking: DataFrame) -> DataFrame:
        """The best rows at or above the floor in each block that ``query_id, q, part, floor`` visit."""
        asks = asking.groupBy("part").agg(F.count("*").alias("asks"))
        # one row per part, and there are at most MOST_PARTS
        cuts = cut_lineage(
            sizes.join(asks, "part").select(
                "part", F.ceil(F.col("n") / block_rows).cast("int").alias("row_blocks"), F.ceil(F.col("asks") / block_rows).cast("int").alias("query_blocks")
            )
        )
        left = indexed.join(F.broadcast(cuts), "part").select("part", block("id", "row_blocks").alias("rb"), every("query_blocks").alias("qb"), "id", "v")
        right = asking.join(F.broadcast(cuts), "part").select(
            "part", every("row_blocks").alias("rb"), block("query_id", "query_blocks").alias("qb"), "query_id", "q", "floor"
        )
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, "query_id bigint, id bigint, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    top = lambda found: found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
    # the likeliest part first: rows of other parts that score below its k-th cannot be among the nearest
    likeliest = F.col("part") == F.col("first_part")
    opening = cut_lineage(top(scored(visiting.filter(likeliest).select("query_id", "q", "part", F.lit(float("-inf")).alias("floor")))))
    floors = opening.filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    rest = visiting.filter(~likeliest).join(floors, "query_id", "left").select("query_id", "q", "part", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    out = cut_lineage(top(scored(rest).unionByName(opening.select("query_id", "id", "score"))))
    for step in (indexed, seen, opening):
        discard(step)
    return out


def brute_force(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, k: int) -> dict[int, list[tuple[int, float]]]:
    """Exact answers for one vector per id; for tests and recall."""
    out = {}
    place = {int(i): n for n, i in enumerate(ids)}
    for query in query_ids.tolist():
        scores = (vectors * vectors[place[query]]).sum(axis=1)
        order = [n for n in np.lexsort((ids, -scores)) if ids[n] != query][:k]
        out[query] = [(int(ids[n]), float(scores[n])) for n in order]
    return out
