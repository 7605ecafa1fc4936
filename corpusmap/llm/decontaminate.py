"""Benchmark decontamination with suffix arrays of the training text.

Every slice of the documents is a shard with its own suffix array, and every suffix of every
benchmark item is binary-searched in it. Only suffixes that a search could ever return enter the
array: their words are numbered by the benchmark's vocabulary, and a suffix whose first words
contain a word that no item has cannot equal any item's window. That leaves few suffixes of a
shard, in memory that the slice bounds, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusmap.llm.common import alnum_words, as_bytes, fresh, slices
from corpusmap.session import cut_lineage

WINDOW = 13
BLOCK_BYTES = 32 << 20

FOUND = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,matches:array<struct<item_id:string,start:bigint,item_start:bigint,length:bigint>>>"


class Items:
    """A block of benchmark items: numbered words and distinct windows, sorted for searching."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window, self.ids = window, [name for name, _ in items]
        self.number: dict[bytes, int] = {}
        self.words = []
        for _, text in items:
            self.words.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in alnum_words(text)], "<i4"))
        holders: dict[bytes, list[tuple[int, int]]] = {}
        for item, words in enumerate(self.words):
            width = min(window, len(words))
            for start in range(len(words) - width + 1 if width else 0):
                holders.setdefault(words[start : start + width].astype(">i4").tobytes(), []).append((item, start))
        self.keys = sorted(holders)
        self.owners = [sorted({item for item, _ in holders[k]}) for k in self.keys]
        self.automata: dict[int, Suffixes] = {}
        self.widths = np.array([len(k) // 4 for k in self.keys], "i8")
        full = 4 * window
        self.low = np.array([k.ljust(full, b"\0") for k in self.keys], f"S{full}")
        self.high = np.array([k.ljust(full, b"\xff") for k in self.keys], f"S{full}")
        self.least = int(self.widths.min()) if len(self.keys) else 0
        self.heads = np.unique([int.from_bytes(k[:4], "big") for k in self.keys if len(k) < full]).astype("i4")

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``words`` (0: unknown or a border) and the window that starts there, all pairs."""
        none = np.zeros(0, "i8")
        if not len(self.keys) or not len(words):
            return none, none
        stops = np.append(np.flatnonzero(words == 0), len(words))
        ahead = stops[np.searchsorted(stops, np.arange(len(words)))] - np.arange(len(words))
        enter = ahead >= self.window
        if len(self.heads):
            enter |= (ahead >= self.least) & np.isin(words, self.heads)
        suffixes = np.flatnonzero(enter)
        if not len(suffixes):
            return none, none
        padded = np.append(words, np.zeros(self.window, words.dtype))
        prefixes = padded[suffixes[:, None] + np.arange(self.window)]
        # what follows a border belongs to another text
        prefixes[np.arange(self.window) >= ahead[suffixes, None]] = 0
        keys = np.ascontiguousarray(prefixes.astype(">i4")).view(f"S{4 * self.window}").ravel()
        order = np.argsort(keys, kind="stable")
        array = keys[order]
        low, high = np.searchsorted(array, self.low, "left"), np.searchsorted(array, self.high, "right")
        count = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(count)), count)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return suffixes[order[low[which] + within]], which

    def matches(self, words: np.ndarray, windows: np.ndarray) -> list[dict]:
        """For each item that has one of the windows, the longest verbatim match with the text: the first of these in it, then in the item."""
        found = []
        for item in sorted({item for window in np.unique(windows).tolist() for item in self.owners[window]}):
            length, start, at = self.suffixes(item).longest(words.tolist())
            found.append({"item_id": self.ids[item], "start": start, "item_start": at, "length": length})
        return found

    def suffixes(self, item: int) -> "Suffixes":
        """The automaton of an item, made when first needed."""
        if item not in self.automata:
            self.automata[item] = Suffixes(self.words[item].tolist())
        return self.automata[item]


class Suffixes:
    """All word sequences of an item as the paths of its suffix automaton, so a text is matched in one pass whatever repeats."""

    def __init__(self, words: list[int]):
        self.onward: list[dict[int, int]] = [{}]
        self.length, self.link, self.ends = [0], [-1], [0]
        last = 0
        for i, w in enumerate(words):
            new = self._state({}, i + 1, 0, i + 1)
            at = last
            while at >= 0 and w not in self.onward[at]:
                self.onward[at][w] = new
                at = self.link[at]
            if at >= 0:
                to = self.onward[at][w]
                if self.length[to] == self.length[at] + 1:
                    self.link[new] = to
                else:
                    copy = self._state(dict(self.onward[to]), self.length[at] + 1, self.link[to], self.ends[to])
                    while at >= 0 and self.onward[at].get(w) == to:
                        self.onward[at][w] = copy
                        at = self.link[at]
                    self.link[to] = self.link[new] = copy
            last = new

    def _state(self, onward: dict[int, int], length: int, link: int, end: int) -> int:
        self.onward.append(onward)
        self.length.append(length)
        self.link.append(link)
        self.ends.append(end)
        return len(self.length) - 1

    def longest(self, words: list[int]) -> tuple[int, int, int]:
        """Length and first places, in the text and in the item, of the longest sequence that both have."""
        state = size = 0
        best = (0, 0, 0)
        for i, w in enumerate(words):
            while state and w not in self.onward[state]:
                state = self.link[state]
                size = self.length[state]
            if w in self.onward[state]:
                state, size = self.onward[state][w], size + 1
                if size > best[0]:
                    best = (size, i + 1 - size, self.ends[state] - size)
        return best


def find(items: Items, texts: list[bytes | None]) -> list[dict]:
    """Word count, covered word ranges and matches of each text."""
    out, get = [], items.number.get
    for first, last in slices(texts):
        numbers, bounds = [], [0]
        for text in texts[first:last]:
            numbers += [get(w, 0) for w in alnum_words(text)]
            numbers.append(0)
            bounds.append(len(numbers))
        words = np.array(numbers, "<i4")
        starts, which = items.search(words)
        order = np.lexsort((which, starts))
        starts, which = starts[order], which[order]
        cuts = np.searchsorted(starts, bounds)
        for k in range(last - first):
            found = {"n_words": bounds[k + 1] - bounds[k] - 1, "spans": [], "matches": []}
            if cuts[k] < cuts[k + 1]:
                at, wins = starts[cuts[k] : cuts[k + 1]] - bounds[k], which[cuts[k] : cuts[k + 1]]
                ends = np.maximum.accumulate(at + items.widths[wins])
                opens = np.append(True, at[1:] > ends[:-1])
                closes = np.append(np.flatnonzero(opens)[1:] - 1, len(at) - 1)
                found["spans"] = [{"start": a, "end": b} for a, b in zip(at[opens].tolist(), ends[closes].tolist())]
                found["matches"] = items.matches(words[bounds[k] : bounds[k + 1] - 1], wins)
            out.append(found)
    return out


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of about ``block_bytes``; only one block is in the driver at a time."""
    rows = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text")
    ).filter("text is not null and text <> ''")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = total // block_bytes + 1
    rows = rows.distinct().withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count)))
    for block in range(count):
        yield [(r.item, r.text.encode()) for r in rows.filter(F.col("block") == block).collect()]


def find_column(spark, items: list[tuple[str, bytes]], text: Column, window: int = WINDOW) -> Column:
    """What the texts share with one block of items, as a column."""
    held = spark.sparkContext.broadcast(items)

    @arrow_udf(FOUND)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = Items(held.value, window)
        kind = pa.struct(
            [
                ("n_words", pa.int64()),
                ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ("matches", pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())]))),
            ]
        )
        for batch in batches:
            yield pa.array(find(block, as_bytes(batch)), kind)

    return search(text)


def covered(spans: str) -> Column:
    """Words inside at least one of the ranges."""
    return F.expr(
        f"aggregate(array_sort({spans}), named_struct('n', 0L, 'upto', 0L), (a, s) -> "
        "named_struct('n', a.n + greatest(0L, s.end - greatest(s.start, a.upto)), 'upto', greatest(a.upto, s.end)), a -> a.n)"
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, out_col: str = "benchmark_found",
) -> DataFrame:
    """``docs`` with a column ``out_col``: n_words, n_hit, matches and items. A column of that name is replaced, others stay.

    A window is ``window`` consecutive words of an item, or all words of a shorter one; a document
    word inside any occurrence is hit. ``matches`` gives for each item with occurring windows the
    longest verbatim match that starts with one, with its place in both texts; ``items`` the ids as sorted strings.

    Null and empty texts have no words and no hits; null or empty items match nothing; an item
    without an id is listed under the empty string; repeated items count once per id; a document
    row is judged alone, so repeated rows get equal results. An empty benchmark hits nothing.
    """
    spark, name, cut = docs.sparkSession, out_col, 0
    other = fresh("benchmark_more", docs)
    out = docs
    for items in benchmark_blocks(benchmark, item_col, item_text_col, block_bytes):
        more = find_column(spark, items, F.col(text_col).cast("string"), window)
        if cut == 0:
            out = out.withColumn(name, more)
        else:  # one block after the other, each in its own pass
            out = cut_lineage(out).withColumn(other, more)
            out = out.withColumn(
                name,
                F.struct(
                    F.col(f"{name}.n_words").alias("n_words"),
                    F.concat(f"{name}.spans", f"{other}.spans").alias("spans"),
                    F.concat(f"{name}.matches", f"{other}.matches").alias("matches"),
                ),
            ).drop(other)
        cut += 1
    return out.withColumn(
        name,
        F.struct(
            F.col(f"{name}.n_words").alias("n_words"),
            covered(f"{name}.spans").alias("n_hit"),
            F.col(f"{name}.matches").alias("matches"),
            F.array_sort(F.array_distinct(F.transform(f"{name}.matches", lambda m: m["item_id"]))).alias("items"),
        ),
    )


def is_contaminated(found: str = "benchmark_found", share: int = 20) -> Column:
    """At least one word hit, and one of ``share`` words or more."""
    return F.expr(f"{found}.n_hit > 0 and {share} * {found}.n_hit >= {found}.n_words")


def brute_force(texts: list[str | None], items: list[tuple[str, str | None]], window: int = WINDOW) -> pd.DataFrame:
    """The contract by comparing every window with every position; for tests."""
    rows = []
    split = lambda t: alnum_words(t.encode() if t else None)
    for text in texts:
        words, hit, names = split(text), set(), set()
        for name, other in items:
            own = split(other)
            width = min(window, len(own))
            windows = {tuple(own[i : i + width]) for i in range(len(own) - width + 1)} if width else set()
            for i in range(len(words) - width + 1 if width else 0):
                if tuple(words[i : i + width]) in windows:
                    hit |= set(range(i, i + width))
                    names.add(name)
        rows.append((len(words), len(hit), sorted(names)))
    return pd.DataFrame(rows, columns=["n_words", "n_hit", "items"])
