"""Numpy kernels for one Arrow batch or one block of vectors inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

METRICS = ("l2", "cosine", "dot", "hamming")
# So many numbers of either side are gathered at a time.
GATHER = 1 << 22
# Rows and columns of products worked out at once: they stay in the processor's cache. Products of one stretch of full matrices.
_TILE = (512, 1024)
_STRETCH = 1 << 22


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as an (n, d) float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunk at all
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    n = len(column)
    if n == 0:
        return np.zeros((0, 0))
    lengths = column.value_lengths()
    if lengths.null_count:
        raise ValueError("a vector is null")
    if len(lengths.unique()) > 1:
        raise ValueError("vectors differ in length")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, -1)


def prepare(x: np.ndarray, metric: str) -> np.ndarray:
    """Map vectors to the space in which the metric is Euclidean or a dot product."""
    if metric == "cosine":
        length = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, length, out=np.zeros_like(x), where=length > 0)
    if metric == "hamming":
        return (x > 0).astype(np.float64)
    return x


def rough_distances(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    """All distances by one matrix product; precise up to rounding."""
    products = q @ x.T
    if metric == "dot":
        return -products
    squares = (q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2.0 * products
    return np.maximum(squares, 0.0)


def pair_distances(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    """Precise distance of aligned rows."""
    if metric == "dot":
        return -(q * x).sum(1)
    squares = ((q - x) ** 2).sum(1)
    if metric == "l2":
        return np.sqrt(squares)
    return squares / 2.0 if metric == "cosine" else squares


def order_key(ids: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Ids as an array that numpy can sort."""
    values = ids.to_numpy(zero_copy_only=False)
    return values.astype(str) if values.dtype == object else values


def keep_nearest(query: np.ndarray, distance: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest (distance, id) per query, sorted by query."""
    order = np.lexsort((ids, distance, query))
    sorted_query = query[order]
    starts = np.r_[0, np.flatnonzero(np.diff(sorted_query)) + 1] if len(order) else np.array([], int)
    lengths = np.diff(np.r_[starts, len(order)])
    rank = np.arange(len(order)) - np.repeat(starts, lengths)
    return order[rank < k]


def same_ids(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and in ``b`` of all pairs of equal ids."""
    order = np.argsort(b, kind="stable")
    held = b[order]
    low = np.searchsorted(held, a, "left")
    count = np.searchsorted(held, a, "right") - low
    at = np.repeat(np.arange(len(a)), count)
    to = order[np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)]
    equal = a[at] == b[to]
    return at[equal], to[equal]


def nearest_in_block(
    q: np.ndarray, x: np.ndarray, k: int, metric: str, x_ids: np.ndarray, q_ids: np.ndarray | None = None, limit: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, x row, distance) of each query's k nearest, ties to the smaller id.

    With ids of queries given, a row is never its own neighbour. With ``limit``, rows farther than that may be left out; it is
    a rough distance per query. Inputs are already prepared for the metric.
    """
    if not len(q) or not len(x):
        empty = np.array([], dtype=int)
        return empty, empty, np.array([])
    # Slack for the rounding of the matrix product, so that ties at the edge all survive.
    squares, lengths = (q * q).sum(1), (x * x).sum(1)
    slack = 1e-9 * (1.0 + squares + lengths.max())
    if limit is None:
        rough = rough_distances(q, x, metric)
        if q_ids is not None:
            rough[same_ids(q_ids, x_ids)] = np.inf
        bound = np.partition(rough, k - 1, axis=1)[:, k - 1] if k < len(x) else np.full(len(q), np.inf)
        rows, cols = np.nonzero((rough <= (bound + slack)[:, None]) & np.isfinite(rough))
    else:
        rows, cols, many = _perhaps_near(q, x, limit + slack, k)
        if q_ids is not None:
            other = ~(q_ids[rows] == x_ids[cols])
            rows, cols = rows[other], cols[other]
        found = [(rows, cols)]
        step = max(1, _STRETCH // len(x))
        for start in range(0, len(many), step):
            at = many[start : start + step]
            row, col = _surely_near(q[at], x, k, squares[at] - limit[at] - slack[at], slack[at], lengths, x_ids, None if q_ids is None else q_ids[at])
            found.append((at[row], col))
        rows, cols = (np.concatenate([f[i] for f in found]) for i in range(2))
    distance, run = np.empty(len(rows)), max(1, GATHER // max(1, x.shape[1]))
    for start in range(0, len(rows), run):
        part = slice(start, start + run)
        distance[part] = pair_distances(q[rows[part]], x[cols[part]], metric)
    turn = np.empty(len(x), int)
    turn[np.argsort(x_ids, kind="stable")] = np.arange(len(x))
    keep = keep_nearest(rows, distance, turn[cols], k)
    return rows[keep], cols[keep], distance[keep]


def _perhaps_near(q: np.ndarray, x: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, x row) of all pairs that may lie within the limit of their query, and queries with too many of them.

    Products of rounded vectors rule out the others, with a border for what rounding may change. Vectors count from the middle
    of the rows, so that the border is small also where all lie far from the origin.
    """
    middle = x.mean(0)
    a, b = q - middle, x - middle
    own, lengths = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    largest, none = lengths.max(), np.array([], dtype=int)
    if not own.max() + largest < 1e30:  # beyond single precision, or no numbers
        return none, none, np.arange(len(q))
    border = 1.2e-7 * (x.shape[1] + 16) * (2.0 * np.sqrt(own * largest) + largest)
    floor = np.nextafter((own - limit - border).astype("f4"), np.float32(-np.inf))
    a, b = np.column_stack([2.0 * a, np.full(len(a), -1.0)]).astype("f4"), np.column_stack([b, lengths]).astype("f4")
    wide, enough = ~np.isfinite(floor), 4 * k if 4 * k < len(x) else len(x)
    rows, cols, many = [none], [none], [np.flatnonzero(wide)]
    asked = np.flatnonzero(~wide)
    for i in range(0, len(asked), _TILE[0]):
        at, held = asked[i : i + _TILE[0]], []
        low, seen = floor[at], np.zeros(len(at), int)
        for j in range(0, len(b), _TILE[1]):
            near = a[at] @ b[j : j + _TILE[1]].T
            some = np.flatnonzero((near.max(1) >= low) & (seen <= enough))
            row, col = np.nonzero(near[some] >= low[some, None])
            np.add.at(seen, some[row], 1)
            held.append((some[row], col + j))
        row, col = (np.concatenate([h[n] for h in held]) for n in range(2))
        few = seen[row] <= enough
        rows.append(at[row[few]])
        cols.append(col[few])
        many.append(at[seen > enough])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(many)


def _surely_near(q, x, k, floor, slack, lengths, x_ids, q_ids) -> tuple[np.ndarray, np.ndarray]:
    """(query row, x row) of the pairs over their query's floor, of many such only those near the k nearest."""
    near = np.column_stack([2.0 * q, np.full(len(q), -1.0)]) @ np.column_stack([x, lengths]).T  # one product says how near a row is
    if q_ids is not None:
        near[same_ids(q_ids, x_ids)] = -np.inf
    close = near >= np.maximum(floor, -np.finfo(float).max)[:, None]
    many = np.flatnonzero(np.count_nonzero(close, axis=1) > 4 * k) if 4 * k < len(x) else []
    if len(many):
        some = near[many]
        last = np.partition(some, len(x) - k, axis=1)[:, len(x) - k]
        close[many] &= some >= (last - 2.0 * slack[many])[:, None]
    return np.nonzero(close)


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union the sets of ``a[i]`` and ``b[i]``; every label is the smallest member's position."""
    while True:
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return labels
        np.minimum.at(labels, np.maximum(la, lb)[differ], np.minimum(la, lb)[differ])
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped
