"""Cutting a vector space into cells of two levels, and searching cells block by block.

A bounded number of real rows, drawn by id hash, are the first pivots and may travel to every task. Inside each of their
cells a grouped job draws second pivots, as many as its rows ask for, so cells keep their size however many rows there
are, and nothing about the second level ever meets in one place. A search rules out cells by both levels.

Where vectors are so little clustered that a query must look into many cells, no copy of it travels to each of them: queries
and rows are packed into blocks, which stay where they are, and every pair of blocks that cannot be ruled out is read by
one task. So what is written grows with the rows, whatever the number of cells to look into.
"""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusmap.functions import blocks
from corpusmap.operators.rows import hash_order, smallest
from corpusmap.session import cut_lineage, discard, spread

# First pivots, second ones of one first cell, and rows of a second cell.
MAX_PIVOTS = 4096
MAX_INNER = 8192
CELL_ROWS = 1024
BLOCK_ROWS = 8192
QUERY_ROWS = 4096
# First cells whose second cells a query looks into before there is a bound.
FIRST_PROBES = 2
SLACK = 1e-9
# More cells than that for a query, and blocks meet instead of copies of queries; queries that try it out.
ROUTED_CELLS = 8
TRIED_QUERIES = 64
# Of what rules out blocks and rows of blocks, to be on the safe side of rounded roots.
LOOSE = 1e-6
# Bytes of the vectors in one block, and how blocks are written: a few in a piece that one task reads.
PACKED_BYTES = 1 << 23
PACKED = {"parquet.block.size": str(1 << 25), "parquet.page.size.row.check.min": "1", "compression": "none"}
# Bits of a cell's number that tell the second cells of one first cell apart.
INNER_BITS = 20

settle = cut_lineage


def to_space(distance: np.ndarray, metric: str) -> np.ndarray:
    """A metric's distance as Euclidean distance between prepared vectors."""
    if metric == "cosine":
        return np.sqrt(2.0 * np.maximum(distance, 0.0))
    return np.sqrt(distance) if metric == "hamming" else distance


def thin(pivots: np.ndarray, spacing: float) -> np.ndarray:
    """Positions of pivots that keep a minimum spacing; copies always collapse."""
    kept: list[int] = []
    for i, p in enumerate(pivots):
        if not kept or ((pivots[kept] - p) ** 2).sum(1).min() > spacing * spacing:
            kept.append(i)
    return np.array(kept, dtype=int)


def far_apart(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(blocks.rough_distances(x, pivots, "l2"))


def paired(left: DataFrame, right: DataFrame, key: str, left_rows: int, right_rows: int):
    """Both sides, cogrouped by ``key`` and by a block of each: no group holds more than a block of either side.

    Rows are dealt by hash of ``id`` and ``vector`` and copied to every block of the other side. Sizes are counted and joined,
    so the driver sees none of them. Keys that only one side has are left out.
    """
    sizes = left.groupBy(key).agg(F.count(F.lit(1)).alias("nl")).join(right.groupBy(key).agg(F.count(F.lit(1)).alias("nr")), key)
    sizes = sizes.select(key, F.ceil(F.col("nl") / left_rows).cast("int").alias("nl"), F.ceil(F.col("nr") / right_rows).cast("int").alias("nr"))

    def dealt(side: DataFrame, own: str, other: str, own_block: str, other_block: str):
        rows = side.join(sizes, key).withColumn(own_block, F.pmod(F.xxhash64("id", "vector"), F.col(own)).cast("int"))
        rows = rows.withColumn(other_block, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return rows.select(*side.columns, "lb", "rb").groupBy(key, "lb", "rb")

    return dealt(left, "nl", "nr", "lb", "rb").cogroup(dealt(right, "nr", "nl", "rb", "lb"))


def early(rows: DataFrame, key: str, wanted: dict[int, int], sizes: dict[int, int], salt: int) -> DataFrame:
    """Of each group, a hash share of its rows with about twice the number wanted: ``rows`` with ``wanted`` and ``turn``.

    One line per first cell goes along.
    """
    layout = rows.sparkSession.createDataFrame([(int(c), int(w), int(sizes[c])) for c, w in wanted.items()], f"{key} int, wanted int, rows bigint")
    turn = hash_order(F.lit(salt), "id")
    share = F.conv(F.substring(turn, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))
    some = rows.join(F.broadcast(layout), key).filter(share <= (2 * F.col("wanted") + 16) / F.col("rows"))
    return some.drop("rows").withColumn("turn", turn)


class _Asked:
    """A block of queries with the k nearest rows met so far; their distance rules out rows of later blocks."""

    def __init__(self, asked: int, ids: pa.Array, q: pa.Buffer, bounds: pa.Buffer, k: int, metric: str, exclude_self: bool):
        self.asked, self.ids, self.k, self.metric = asked, ids, k, metric
        self.q, self.limit = unpacked(q, len(ids)), np.frombuffer(bounds, "f8").copy()
        self.loose = LOOSE * (1.0 + np.sqrt((self.q * self.q).sum(1)))
        self.key = blocks.order_key(ids) if exclude_self else None
        self.found: pa.Table | None = None

    def meet(self, ids: pa.Array, x: np.ndarray, counts: np.ndarray, around: np.ndarray, extent: np.ndarray) -> None:
        asking, cells = [], np.zeros(len(counts), bool)
        for part in _parts(len(self.q), len(counts)):
            d = far_apart(self.q[part], around)
            near = floors(d, d.argmin(1), around, extent) <= (self.limit[part] + self.loose[part])[:, None]
            cells |= near.any(0)
            asking.append(near.any(1))
        asking, column = np.flatnonzero(np.concatenate(asking)), np.flatnonzero(np.repeat(cells, counts))
        if not len(asking) or not len(column):
            return
        ids, x = ids.take(pa.array(column)), x[column]
        # rough distances of these metrics are squares of distances in their space
        limit = (self.limit[asking] + self.loose[asking]) ** 2
        key, own = blocks.order_key(ids), None if self.key is None else self.key[asking]
        row, col, distance = blocks.nearest_in_block(self.q[asking], x, self.k, self.metric, key, own, limit)
        at = asking[row]
        if not len(at):
            return
        new = pa.table({"at": at, "id": ids.take(pa.array(col)), "distance": distance})
        rest = new.slice(0, 0)
        if self.found is not None:  # only queries with new rows are sorted again
            again = np.zeros(len(self.q), bool)
            again[at] = True
            again = again[self.found["at"].to_numpy()]
            new, rest = pa.concat_tables([self.found.filter(pa.array(again)), new]), self.found.filter(pa.array(~again))
        keep = blocks.keep_nearest(new["at"].to_numpy(), new["distance"].to_numpy(), blocks.order_key(new["id"]), self.k)
        best = new.take(pa.array(keep))
        self.found = pa.concat_tables([rest, best]).combine_chunks()
        at, distance = best["at"].to_numpy(), best["distance"].to_numpy()
        last = np.append(at[1:] != at[:-1], True)
        full = np.bincount(at, minlength=len(self.q))[at[last]] >= self.k
        at, distance = at[last][full], distance[last][full]
        self.limit[at] = np.minimum(self.limit[at], to_space(distance, self.metric))

    def result(self):
        if self.found is not None:
            ids = self.ids.take(self.found["at"].combine_chunks())
            yield from pa.table({"query_id": ids, "neighbor_id": self.found["id"], "distance": self.found["distance"]}).to_batches()


@dataclasses.dataclass
class Cells:
    """Rows of a vector space at home in cells of two levels.

    ``homes``: ``cell, id, vector, radius`` with prepared vectors; ``stats``: ``coarse, cell, id, vector, size, reach`` of
    the non-empty cells, ``vector`` being their pivot, ``reach`` the distance of the farthest row.
    """

    metric: str
    pivots: np.ndarray
    reach: np.ndarray
    homes: DataFrame
    stats: DataFrame

    @classmethod
    def over(cls, points: DataFrame, metric: str, cells: int | None = None, cell_rows: int = CELL_ROWS) -> "Cells":
        """About ``cell_rows`` rows in a cell, or about ``cells`` cells."""
        points = points.select("id", "vector")
        n = points.count()
        if cells is not None:
            cell_rows = max(1, n // max(1, cells))
        first = max(1, min(MAX_PIVOTS, math.isqrt(max(0, n // cell_rows - 1)) + 1))
        drawn = smallest(points, first, hash_order(F.lit(17), "id")).toArrow()
        drawn = drawn.take(pa.array(np.argsort(blocks.order_key(drawn["id"]), kind="stable")))
        pivots = blocks.prepare(blocks.matrix(drawn["vector"]), metric)
        pivots = pivots[thin(pivots, 0.0)]
        id_type = points.schema["id"].dataType.simpleString()

        def to_first(batches):
            for batch in batches:
                if batch.num_rows:
                    x = blocks.prepare(blocks.matrix(batch.column(1)), metric)
                    d = far_apart(x, pivots)
                    home = d.argmin(1)
                    yield _rows({"coarse": home.astype("i4")}, batch.column(0), x, None, radius=d[np.arange(len(x)), home])

        placed = cut_lineage(spread(points).mapInArrow(to_first, f"coarse int, id {id_type}, vector array<double>, radius double"))
        lines = placed.groupBy("coarse").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("reach")).collect()
        sizes, reach = {r.coarse: r.n for r in lines}, np.full(len(pivots), -np.inf)
        for r in lines:
            reach[r.coarse] = r.reach
        wanted = {c: min(MAX_INNER, -(-n // cell_rows)) for c, n in sizes.items()}
        turn = Window.partitionBy("coarse").orderBy("turn", "id")
        inner = early(placed.select("coarse", "id", "vector"), "coarse", wanted, sizes, 29)
        inner = inner.withColumn("nth", F.row_number().over(turn)).filter("nth <= wanted").select("coarse", "vector")
        own = placed.sparkSession.createDataFrame([(c, pivots[c].tolist()) for c in sizes], "coarse int, vector array<double>")

        def number(group: pa.Table) -> pa.Table:
            x = np.unique(blocks.matrix(group["vector"]), axis=0)
            coarse = group["coarse"][0].as_py()
            cell = (coarse << INNER_BITS) + np.arange(len(x))
            return pa.table({"coarse": pa.array(np.full(len(x), coarse, "i4")), "cell": cell, "id": cell, "vector": _lists(x)})

        inner = cut_lineage(inner.unionByName(own).groupBy("coarse").applyInArrow(number, "coarse int, cell bigint, id bigint, vector array<double>"))

        def to_second(rows: pa.Table, around: pa.Table) -> pa.Table:
            x, p = blocks.matrix(rows["vector"]), blocks.matrix(around["vector"])
            cell = around["cell"].to_numpy()
            order = np.argsort(cell)
            home, radius = np.zeros(len(x), int), np.zeros(len(x))
            for part in _parts(len(x), len(p)):
                d = far_apart(x[part], p[order])
                home[part], radius[part] = d.argmin(1), d.min(1)
            return pa.table({"cell": cell[order][home], "id": rows["id"], "vector": rows["vector"], "radius": radius})

        homes = paired(placed, inner, "coarse", BLOCK_ROWS, 2 * MAX_INNER).applyInArrow(
            to_second, f"cell bigint, id {id_type}, vector array<double>, radius double"
        )
        homes = cut_lineage(homes)
        discard(placed)
        sums = homes.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.max("radius").alias("reach"))
        stats = cut_lineage(sums.join(inner, "cell").select("coarse", "cell", "id", "vector", "size", "reach"))
        discard(inner)
        return cls(metric, pivots, reach, homes, stats)

    def discard(self) -> None:
        discard(self.homes)
        discard(self.stats)

    def search_within(self, queries: DataFrame, k: int, probes: int, exclude_self: bool) -> tuple[DataFrame, bool]:
        """Candidates ``query_id, neighbor_id, distance`` of each query (with its ``bound``), and whether the nearest cells are in it.

        Queries that ask for few cells beyond the nearest are copied to these. If a trial shows that they ask for many, blocks of
        queries meet blocks of rows; then candidates come from all cells, those looked into before included.
        """
        tried = smallest(queries, TRIED_QUERIES, hash_order(F.lit(41), "id"))
        asked = self.cells_within(tried, probes).count()
        if asked <= ROUTED_CELLS * TRIED_QUERIES:
            return search_cells(self.cells_within(queries, probes), self.homes, k, self.metric, exclude_self), False
        return self._search_blocks(queries, k, exclude_self), True

    def _packed_queries(self, queries: DataFrame) -> DataFrame:
        """Blocks of queries that have the same nearest first pivot."""
        metric, pivots = self.metric, self.pivots
        id_type = queries.schema["id"].dataType.simpleString()

        def to_first(batches):
            for batch in batches:
                if batch.num_rows:
                    x = blocks.prepare(blocks.matrix(batch.column(1)), metric)
                    yield _rows({"coarse": far_apart(x, pivots).argmin(1).astype("i4")}, batch.column(0), x, None, bound=batch.column(2))

        asked = queries.select("id", "vector", F.col("bound").cast("double").alias("bound"))
        asked = cut_lineage(spread(asked).mapInArrow(to_first, f"coarse int, id {id_type}, vector array<double>, bound double"))
        size = block_rows(pivots.shape[1], QUERY_ROWS)
        sizes = asked.groupBy("coarse").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts"))

        def pack(group: pa.Table) -> pa.Table:
            x, coarse = blocks.matrix(group["vector"]), group["coarse"][0].as_py()
            bound = group["bound"].to_numpy().astype(float)
            bound = np.where(np.isnan(bound), np.inf, to_space(bound, metric))
            return pa.table(
                {
                    "asked": [(coarse << INNER_BITS) + group["part"][0].as_py()],
                    "q_centre": pa.array([pivots[coarse].tolist()], pa.list_(pa.float64())),
                    "q_reach": [np.fmax.reduce(far_apart(x, pivots[coarse : coarse + 1])[:, 0])],
                    "q_bound": [bound.max()],
                    "q_ids": pa.array([group["id"].to_pylist()], pa.list_(group.schema.field("id").type)),
                    "q": pa.array([x.tobytes()], pa.binary()),
                    "bounds": pa.array([bound.tobytes()], pa.binary()),
                }
            )

        dealt = asked.join(sizes, "coarse").withColumn("part", F.pmod(F.xxhash64("id", "vector"), F.col("parts")).cast("int"))
        packed = dealt.groupBy("coarse", "part").applyInArrow(
            pack, f"asked bigint, q_centre array<double>, q_reach double, q_bound double, q_ids array<{id_type}>, q binary, bounds binary"
        )
        packed = cut_lineage(packed, **PACKED)
        discard(asked)
        return packed

    def _packed_rows(self) -> DataFrame:
        """Blocks of rows of the same first cell, sorted by their second cells."""
        metric, pivots = self.metric, self.pivots
        id_type = self.homes.schema["id"].dataType.simpleString()
        homes = self.homes.select(F.shiftright("cell", INNER_BITS).cast("int").alias("coarse"), "cell", "id", "vector", "radius")

        def pack(rows: pa.Table, around: pa.Table) -> pa.Table:
            rows = rows.take(pa.array(np.argsort(rows["cell"].to_numpy(), kind="stable"))).combine_chunks()
            x, coarse = blocks.matrix(rows["vector"]), rows["coarse"][0].as_py()
            cell, count = np.unique(rows["cell"].to_numpy(), return_counts=True)
            order = np.argsort(around["cell"].to_numpy())
            order = order[np.searchsorted(around["cell"].to_numpy()[order], cell)]
            reach = np.fmax.reduceat(rows["radius"].to_numpy(), np.cumsum(count) - count)
            return pa.table(
                {
                    "r_centre": pa.array([pivots[coarse].tolist()], pa.list_(pa.float64())),
                    "r_reach": [np.fmax.reduce(far_apart(x, pivots[coarse : coarse + 1])[:, 0])],
                    "r_ids": pa.array([rows["id"].to_pylist()], pa.list_(rows.schema.field("id").type)),
                    "x": pa.array([x.tobytes()], pa.binary()),
                    "counts": pa.array([count.astype("i8").tobytes()], pa.binary()),
                    "around": pa.array([blocks.matrix(around["vector"])[order].tobytes()], pa.binary()),
                    "extent": pa.array([reach.tobytes()], pa.binary()),
                }
            )

        packed = paired(homes, self.stats.drop("reach"), "coarse", block_rows(pivots.shape[1], BLOCK_ROWS), 2 * MAX_INNER).applyInArrow(
            pack, f"r_centre array<double>, r_reach double, r_ids array<{id_type}>, x binary, counts binary, around binary, extent binary"
        )
        return cut_lineage(packed, **PACKED)

    def _search_blocks(self, queries: DataFrame, k: int, exclude_self: bool) -> DataFrame:
        metric = self.metric
        query_type, id_type = (side.schema["id"].dataType for side in (queries, self.homes))
        asked, stored = self._packed_queries(queries), self._packed_rows()
        apart = between("q_centre", "r_centre")
        slack = F.lit(LOOSE) * (1 + apart + F.col("q_reach") + F.col("r_reach"))
        ball = apart - F.col("q_reach") - F.col("r_reach") <= F.col("q_bound") + slack
        plane = apart / 2 - F.col("q_reach") <= F.col("q_bound") + slack
        met = all_pairs(asked, stored, ball & plane | F.isnan(apart))
        columns = ["asked", "q_ids", "q", "bounds", "r_ids", "x", "counts", "around", "extent"]

        def search(batches):
            now = None
            for batch in batches:
                for i in range(batch.num_rows):
                    asked, q_ids, q, bounds, r_ids, x, counts, around, extent = (c[i] for c in batch.columns)
                    if now is None or now.asked != asked.as_py():
                        if now is not None:
                            yield from now.result()
                        now = _Asked(asked.as_py(), q_ids.values, q.as_buffer(), bounds.as_buffer(), k, metric, exclude_self)
                    counts, extent = np.frombuffer(counts.as_buffer(), "i8"), np.frombuffer(extent.as_buffer(), "f8")
                    now.meet(r_ids.values, unpacked(x.as_buffer(), len(r_ids.values)), counts, unpacked(around.as_buffer(), len(counts)), extent)
            if now is not None:
                yield from now.result()

        kinds = f"query_id {query_type.simpleString()}, neighbor_id {id_type.simpleString()}, distance double"
        found = cut_lineage(met.select(*columns).mapInArrow(search, kinds))
        discard(asked)
        discard(stored)
        return found

    def nearest_cells(self, queries: DataFrame, probes: int) -> DataFrame:
        """Each query with the ``probes`` nearest cells of each of its nearest first cells: ``cell, id, vector``."""
        return self._route(queries.select("id", "vector", F.lit(None).cast("double").alias("bound")), probes, False)

    def cells_within(self, queries: DataFrame, probes: int) -> DataFrame:
        """Each query (with its ``bound``) with the other cells that may hold a nearer row."""
        return self._route(queries.select("id", "vector", "bound"), probes, True)

    def _route(self, queries: DataFrame, probes: int, beyond: bool) -> DataFrame:
        metric, reach, pivots = self.metric, self.reach, self.pivots
        id_type = queries.schema["id"].dataType.simpleString()

        def to_first(batches):
            for batch in batches:
                if not batch.num_rows or not len(pivots):
                    continue
                x = blocks.prepare(blocks.matrix(batch.column(1)), metric)
                d = far_apart(x, pivots)
                order = d.argsort(1, kind="stable")
                near = np.zeros(d.shape, bool)
                np.put_along_axis(near, order[:, :FIRST_PROBES], True, 1)
                bound = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
                bound = np.where(np.isnan(bound), np.inf, to_space(bound, metric))
                chosen = floors(d, order[:, 0], pivots, reach) <= bound[:, None] + SLACK if beyond else near
                at, coarse = np.nonzero(chosen)
                yield _rows({"coarse": coarse.astype("i4")}, batch.column(0), x, at, bound=bound[at], near=near[at, coarse])

        routed = spread(queries).mapInArrow(to_first, f"coarse int, id {id_type}, vector array<double>, bound double, near boolean")
        routed = cut_lineage(routed)

        def to_second(asked: pa.Table, around: pa.Table) -> pa.Table:
            x, p = blocks.matrix(asked["vector"]), blocks.matrix(around["vector"])
            bound, near = asked["bound"].to_numpy(), asked["near"].to_numpy()
            cell, extent = around["cell"].to_numpy(), around["reach"].to_numpy()
            rows, columns = [], []
            for part in _parts(len(x), len(p)):
                d = far_apart(x[part], p)
                order = np.lexsort((np.broadcast_to(cell, d.shape), d))
                seen = np.zeros(d.shape, bool)
                np.put_along_axis(seen, order[:, :probes], True, 1)
                seen &= near[part, None]
                chosen = ~seen & (floors(d, order[:, 0], p, extent) <= bound[part, None] + SLACK) if beyond else seen
                at, column = np.nonzero(chosen)
                rows.append(at + part.start)
                columns.append(column)
            at, column = np.concatenate(rows), np.concatenate(columns)
            return pa.table({"cell": cell[column], "id": asked["id"].take(pa.array(at)), "vector": _lists(x[at])})

        return paired(routed, self.stats, "coarse", QUERY_ROWS, 2 * MAX_INNER).applyInArrow(
            to_second, f"cell bigint, id {id_type}, vector array<double>"
        )


def floors(d: np.ndarray, nearest: np.ndarray, pivots: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """What each cell's rows are away from each query at least: they lie within its reach, on its side of the bisecting plane."""
    near = d[np.arange(len(d)), nearest][:, None]
    some, of = np.unique(nearest, return_inverse=True)
    apart = far_apart(pivots[some], pivots)[of]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (d * d - near * near) / (2.0 * apart)
    return np.where(np.isneginf(reach)[None, :], np.inf, np.fmax(d - reach[None, :], plane))


def _parts(n: int, width: int) -> list[slice]:
    """Stretches of rows whose products with the other side stay small."""
    step = max(1, (1 << 22) // max(1, width))
    return [slice(i, min(n, i + step)) for i in range(0, n, step)]


def _lists(x: np.ndarray) -> pa.Array:
    x = np.ascontiguousarray(x)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def _rows(lead: dict, ids: pa.Array, x: np.ndarray, at: np.ndarray | None, **more) -> pa.RecordBatch:
    if at is not None:
        ids, x = ids.take(pa.array(at)), x[at]
    columns = {**lead, "id": ids, "vector": _lists(x), **more}
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def block_rows(dims: int, rows: int, most: int = PACKED_BYTES) -> int:
    """At most ``rows`` rows in a block, fewer if their vectors are long."""
    return max(1, min(rows, most // (8 * max(1, dims))))


def unpacked(value: bytes, rows: int) -> np.ndarray:
    """The vectors of a packed block."""
    return np.frombuffer(value, "f8").reshape(rows, -1)


def between(a: str, b: str) -> Column:
    """Euclidean distance of two array columns."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def all_pairs(left: DataFrame, right: DataFrame, possible: Column) -> DataFrame:
    """Every possible pair of blocks: nothing is shuffled, a task reads its blocks of both sides."""
    return left.join(right.hint("shuffle_replicate_nl"), possible)


def search_cells(probes: DataFrame, homes: DataFrame, k: int, metric: str, exclude_self: bool) -> DataFrame:
    """Candidates ``query_id, neighbor_id, distance`` of the probed cells, k per query and block.

    A large cell is split into blocks of rows, and its queries into blocks of queries, so no task
    sees more than one block of each.
    """
    probes = cut_lineage(probes)
    found = cut_lineage(block_search(probes, homes, "cell", k, metric, exclude_self))
    discard(probes)
    return found


def block_search(queries: DataFrame, rows: DataFrame, key: str, k: int, metric: str, exclude_self: bool = False) -> DataFrame:
    """The k nearest of each query in each block of rows that has its ``key``; vectors are prepared for the metric."""
    query_type, id_type = (side.schema["id"].dataType.simpleString() for side in (queries, rows))

    def search(asked: pa.Table, stored: pa.Table) -> pa.Table:
        q, x = blocks.matrix(asked["vector"]), blocks.matrix(stored["vector"])
        x_key = blocks.order_key(stored["id"])
        q_key = blocks.order_key(asked["id"]) if exclude_self else None
        found = []
        for part in _parts(len(q), len(x)):
            at, col, distance = blocks.nearest_in_block(q[part], x, k, metric, x_key, None if q_key is None else q_key[part])
            found.append((at + part.start, col, distance))
        at, col, distance = (np.concatenate([f[i] for f in found]) for i in range(3)) if found else ([], [], [])
        return pa.table(
            {
                "query_id": asked["id"].take(pa.array(at, pa.int64())),
                "neighbor_id": stored["id"].take(pa.array(col, pa.int64())),
                "distance": pa.array(distance, pa.float64()),
            }
        )

    return paired(queries, rows.select(key, "id", "vector"), key, QUERY_ROWS, BLOCK_ROWS).applyInArrow(
        search, f"query_id {query_type}, neighbor_id {id_type}, distance double"
    )


def dealt_into_one(df: DataFrame, metric: str) -> DataFrame:
    """``cell, id, vector`` with prepared vectors, all in one cell: what has no cells is compared block by block."""
    id_type = df.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield _rows({"cell": np.zeros(batch.num_rows, "i8")}, batch.column(0), blocks.prepare(blocks.matrix(batch.column(1)), metric), None)

    return df.select("id", "vector").mapInArrow(run, f"cell bigint, id {id_type}, vector array<double>")
