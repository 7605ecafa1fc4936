"""Near duplicates by SimHash, paired through vantage-point trees.

Two fingerprints within 3 bits agree to within 1 bit in one of their 32-bit halves. Each half has a
vantage-point tree: a node sends a value at distance d from its vantage point to the near side if
d <= m and to the far side otherwise. By the triangle inequality two values within 1 bit can only be
parted when their distances are m and m + 1, so values at m + 1 also visit the near side and every
pair meets in a leaf; all other branches are pruned. Leaves are shards of the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusmap.llm.common import LOWER, as_bytes, space_words
from corpusmap.operators.components import connected_components
from corpusmap.operators.rows import hash_order, smallest
from corpusmap.session import cut_lineage, discard

SHINGLE, BITS, SEED = 3, 3, 42
SAMPLE = 1 << 15
LEAF_ROWS = 1024
BLOCK_ROWS = 8192


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = space_words(text.translate(LOWER)) if text else []
    if not words:
        return 0
    columns = [words[i:] for i in range(min(shingle, len(words)))]
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(s, SEED) for s in map(b" ".join, zip(*columns))], "<u8")
    ones = np.zeros(64, "i8")
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """64-bit SimHash of each whole text, as a signed long; null and wordless texts get 0."""

    @arrow_udf("bigint")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.array([fingerprint(t, shingle) for t in as_bytes(batch)], "u8").view("i8"))

    return compute(text.cast("string"))


class Tree:
    """A vantage-point tree over 32-bit values, built from a sample and used to route all values."""

    def __init__(self, sample: np.ndarray, leaf: int, seed: int):
        random = np.random.default_rng(seed)
        self.point, self.bound, self.near, self.far = [], [], [], []  # near < 0: leaf number -near - 1
        self.leaves = 0
        waiting = [(np.unique(sample), None, None)]
        while waiting:
            values, parent, side = waiting.pop()
            cut = self._cut(values, random) if len(values) > leaf else None
            if cut is None:
                node, self.leaves = -self.leaves - 1, self.leaves + 1
            else:
                node = len(self.point)
                point, bound = cut
                self.point.append(point)
                self.bound.append(bound)
                self.near.append(0)
                self.far.append(0)
                d = np.bitwise_count(values ^ point)
                waiting += [(values[d <= bound + 1], node, self.near), (values[d > bound], node, self.far)]
            if parent is not None:
                side[parent] = node
        self.root = 0 if self.point else -1
        self.point, self.bound = np.array(self.point, "u4"), np.array(self.bound, "i8")
        self.near, self.far = np.array(self.near, "i8"), np.array(self.far, "i8")

    @staticmethod
    def _cut(values: np.ndarray, random) -> tuple[np.uint32, int] | None:
        """Of a few sample points and bounds, the pair whose larger side is smallest; None if no side shrinks enough."""
        best, least = None, 0.8 * len(values)
        for point in random.choice(values, min(8, len(values)), replace=False):
            upto = np.cumsum(np.bincount(np.bitwise_count(values ^ point), minlength=34))
            for bound in range(32):
                larger = max(upto[bound + 1], len(values) - upto[bound])
                if upto[bound] and larger < least:
                    best, least = (point, bound), larger
        return best

    def route(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and leaves; a row appears once for each leaf it belongs to or visits."""
        row, node = np.arange(len(values)), np.full(len(values), self.root)
        rows, leaves = [row[node < 0]], [-node[node < 0] - 1]
        row, node = row[node >= 0], node[node >= 0]
        while len(row):
            d = np.bitwise_count(values[row] ^ self.point[node]).astype("i8")
            bound = self.bound[node]
            near, far = d <= bound + 1, d > bound
            row = np.concatenate([row[near], row[far]])
            node = np.concatenate([self.near[node[near]], self.far[node[far]]])
            rows.append(row[node < 0])
            leaves.append(-node[node < 0] - 1)
            row, node = row[node >= 0], node[node >= 0]
        return np.concatenate(rows), np.concatenate(leaves)


def forest(values: np.ndarray, other: np.ndarray | None = None, bits: int = BITS) -> list[tuple[int, int]]:
    """Links that join everything within ``bits`` of each other: not all pairs, but the same classes.

    With ``other``, only pairs between the two sets count.
    """
    every = values if other is None else np.concatenate([values, other])
    label, links = np.arange(len(every)), []
    first = 0 if other is None else len(values)
    for i in range(0, len(values), 128):
        close = np.bitwise_count(values[i : i + 128, None] ^ every[None, first:]) <= bits
        close[label[i : i + len(close), None] == label[None, first:]] = False
        for k in np.flatnonzero(close.any(axis=1)):
            partners = first + np.flatnonzero(close[k])
            found, where = np.unique(label[partners], return_index=True)
            mine = label[i + k]
            for other_label, partner in zip(found, partners[where]):
                if other_label != mine:
                    links.append((int(every[i + k]), int(every[partner])))
            touched = found[found != mine]
            if len(touched):
                label[np.isin(label, touched)] = mine
    return links


def near_links(prints: DataFrame, leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS, sample: int = SAMPLE) -> DataFrame:
    """``a, b`` links between the distinct values of column ``fp`` whose classes are those of all pairs within 3 bits.

    The trees are built from at most ``sample`` distinct values; every value is routed. Leaves of
    more than ``block_rows`` values are compared block by block, each pair of blocks in a task of its own.
    """
    spark = prints.sparkSession
    count = prints.count()
    drawn = np.array(sorted(r.fp for r in smallest(prints.select("fp"), sample, hash_order("fp")).collect()), "i8").view("u8")
    leaf = max(2, leaf_rows * len(drawn) // max(count, 1))
    halves = [(drawn >> np.uint64(32 * h)).astype("u4") for h in (0, 1)]
    held = spark.sparkContext.broadcast([Tree(half, leaf, h) for h, half in enumerate(halves)])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for h, tree in enumerate(held.value):
                rows, leaves = tree.route((fp.view("u8") >> np.uint64(32 * h)).astype("u4"))
                for i in range(0, len(rows), 1 << 16):
                    yield pa.record_batch([pa.array(2 * leaves[i : i + (1 << 16)] + h), pa.array(fp[rows[i : i + (1 << 16)]])], ["leaf", "fp"])

    routed = cut_lineage(prints.select("fp").mapInArrow(route, "leaf bigint, fp bigint"))
    large = routed.groupBy("leaf").count().filter(F.col("count") > block_rows)
    large = large.select("leaf", F.ceil(F.col("count") / block_rows).cast("int").alias("blocks"))
    dealt = routed.join(large, "leaf", "left").select(
        "leaf", "fp", F.coalesce("blocks", F.lit(1)).alias("blocks"),
        F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int").alias("own"),
    )
    dealt = dealt.select(
        "leaf", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("met")
    ).select("leaf", "fp", "own", F.least("own", "met").alias("lo"), F.greatest("own", "met").alias("hi"))

    def compare(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view("u8")
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        own = table.column("own").to_numpy()
        links = forest(fp) if lo == hi else forest(fp[own == lo], fp[own == hi])
        pairs = np.array(links, "u8").reshape(-1, 2).view("i8")
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    links = cut_lineage(dealt.groupBy("leaf", "lo", "hi").applyInArrow(compare, "a bigint, b bigint"))
    discard(routed)
    return links


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, mark: Column | None = None, **trees
) -> DataFrame:
    """``id_col, fp, component_id`` for every row of ``docs``; ``fp`` is the fingerprint as a signed long.

    Fingerprints that differ in 3 bits or fewer are linked; ``component_id`` is the smallest id
    reachable over links, the row's own included. Copies share a fingerprint and collapse before any comparison.
    Null and wordless texts have fingerprint 0 and are linked like any other. Rows with a null id
    keep it and link others, but never name a class (null if no id is there to name it). Repeated rows stay.
    With ``mark``, an expression over ``docs``, columns ``mark`` and ``label`` follow; classes with equal labels are one.
    """
    extra = [] if mark is None else [mark.alias("mark")]
    prints = cut_lineage(docs.select(F.col(id_col).alias("id"), fingerprints(F.col(text_col), shingle).alias("fp"), *extra))
    classes = cut_lineage(prints.groupBy("fp").agg(F.min("id").alias("low")))
    links = near_links(classes.select("fp"), **trees)
    labels = connected_components(links).select(F.col("id").alias("fp"), "label")
    linked = classes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    lowest = linked.groupBy("label").agg(F.min("low").alias("component_id"))
    named = linked.join(lowest, "label").select("fp", "component_id", "label")
    found = prints.join(named, "fp")
    return found.select(F.col("id").alias(id_col), "fp", "component_id", *([] if mark is None else ["mark", "label"]))


def hex_print(column: str) -> Column:
    """16 lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def brute_force(texts: list[str | None], ids: list[int], bits: int = BITS) -> pd.DataFrame:
    """Fingerprints, and components from all pairs; for tests."""
    prints = [fingerprint(t.encode() if t else None) for t in texts]
    label = list(range(len(texts)))

    def top(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                label[top(i)] = top(j)
    low: dict[int, int] = {}
    for i, doc in enumerate(ids):
        low[top(i)] = min(doc, low.get(top(i), doc))
    return pd.DataFrame({"doc_id": ids, "fp": prints, "component_id": [low[top(i)] for i in range(len(ids))]})
