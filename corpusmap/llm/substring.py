"""Removal of repeated word windows, found by recompression.

Every round renames runs of equal symbols and then pairs of a left and a right symbol, where the
side of a symbol is a bit of its name. Names are 64-bit hashes of what they stand for, so all
tasks agree on them without a dictionary, and equal word sequences get equal symbols except near
their borders. Each symbol carries the words that its shape depends on; it is stable in a window
that holds all of those. The anchor of a window is its longest stable symbol, which depends on the
window's words alone: equal windows share their anchor. Consecutive windows with one anchor form a
group, and only groups are shuffled, by anchor. A group whose words equal an earlier group's is all
repeats; where groups share the anchor but not the words, their windows are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusmap.llm.common import as_bytes, fresh, slices, space_words
from corpusmap.session import cut_lineage

WINDOW, ROUNDS, FIRST_ROUND = 20, 5, 2
CACHE = 1 << 19
LAST = (1 << 63) - 1

# Odd multipliers and shifts of a 64-bit mixing function.
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
S32 = np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> S32)) * M2
    x = (x ^ (x >> S32)) * M2
    return x ^ (x >> S32)


def salt(number: int) -> np.uint64:
    return np.uint64(number * int(M1) & (1 << 64) - 1)


class WordHashes(dict):
    """Hash by word; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = value
        return value


def window_hashes(words: np.ndarray, window: int, seed: int) -> np.ndarray:
    """A hash of the ``window`` words from each position on, put together from halves."""
    size = max(0, len(words) - window + 1)
    level, width, done, out = mix(words + np.uint64(seed)), 1, 0, np.zeros(size, "u8")
    while done < window:
        if window & width:
            out = mix(out * M1 + level[done : done + size] + np.uint64(width))
            done += width
        if done < window:
            level = mix(level[:-width] * M1 + level[width:]) if len(level) > width else level[:0]
            width *= 2
            if len(level) < size and done + size > len(level):
                level = np.append(level, np.zeros(done + size - len(level), "u8"))
    return out


def rounds(words: np.ndarray, upto: int = ROUNDS) -> Iterator[tuple[np.ndarray, ...]]:
    """After each round: name, start and end of each symbol, and the range of words that it depends on."""
    name, a = words, np.arange(len(words))
    b, left, right = a + 1, a, a + 1
    for number in range(1, upto + 1):
        if len(name) < 2:
            return
        # Runs. That a neighbour differs shows in one word, unless the two agree in it.
        same = name[1:] == name[:-1]
        before = np.append(left[0] - 1, np.where(words[b[:-1] - 1] != words[b[1:] - 1], a[1:] - 1, left[:-1]))
        after = np.append(np.where(words[a[1:]] != words[a[:-1]], b[:-1] + 1, right[1:]), right[-1] + 1)
        heads = np.flatnonzero(np.append(True, ~same))
        tails = np.append(heads[1:], len(name)) - 1
        length = tails - heads + 1
        run = mix(name[heads] * M1 + length.astype("u8") + np.uint64(number << 32))
        left, right = np.minimum(left[heads], before[heads]), np.maximum(right[tails], after[tails])
        name, a, b = np.where(length > 1, run, name[heads]), a[heads], b[tails]
        if len(name) < 2:
            return
        # Pairs.
        is_left = mix(name + salt(number)) >> np.uint64(63) == 1
        pair = is_left[:-1] & ~is_left[1:]
        # A left symbol stays alone because the next one is left too, a right one because the one before is right.
        right_alone = np.where(is_left, np.maximum(right, np.append(right[1:], right[-1] + 1)), right)
        left_alone = np.where(is_left, left, np.minimum(left, np.append(left[0] - 1, left[:-1])))
        opens, second = np.append(pair, False), np.append(False, pair)
        keep = ~second
        joined = mix(mix(name + np.uint64(number)) * M1 + np.append(name[1:], name[:1]))
        merged = opens[keep]
        nxt = np.minimum(np.flatnonzero(keep) + 1, len(name) - 1)
        right = np.where(merged, right[nxt], right_alone[keep])
        left = np.where(merged, left[keep], left_alone[keep])
        name, a, b = np.where(merged, joined[keep], name[keep]), a[keep], np.where(merged, b[nxt], b[keep])
        yield name, a, b, left, right


def anchors(words: np.ndarray, window: int = WINDOW, upto: int = ROUNDS, first: int = FIRST_ROUND) -> np.ndarray:
    """For each position, the longest symbol that is stable in the window from there on: its length
    over 58 bits of its name; 0 if there is none."""
    best = np.zeros(len(words) + 1, "u8")
    for number, (name, a, b, left, right) in enumerate(rounds(words, upto), 1):
        if number < first:
            continue
        fit = (right - left <= window) & (left >= 0) & (right <= len(words))
        name, length, left, right = name[fit], (b - a)[fit], left[fit], right[fit]
        rank = np.minimum(length, 62).astype("u8") << np.uint64(58) | name >> np.uint64(6)
        for shift in range(window):
            at = right - window + shift
            inside = at <= left
            if not inside.any():
                break
            inside &= at >= 0
            np.maximum.at(best, at[inside], rank[inside])
    return best[:-1]


def groups(texts: list[bytes | None], window: int, cache: WordHashes) -> dict[str, np.ndarray]:
    """Groups of consecutive windows with one anchor: row of the text, first window, count, anchor and span hash."""
    listed, bounds = [], [0]
    for text in texts:
        listed += map(cache.__getitem__, space_words(text))
        listed.append(0)
        bounds.append(len(listed))
    words, bounds = np.array(listed, "u8"), np.array(bounds)
    # a border equals nothing else, so no symbol that depends on it is stable in any window
    words[bounds[1:] - 1] = mix(np.arange(len(texts), dtype="u8") + M1)
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    place = np.arange(len(words)) - bounds[row]
    valid = place + window < np.diff(bounds)[row]  # the border is one word
    hashed = np.zeros(len(words), "u8")
    span = window_hashes(words, window, 1)
    hashed[: len(span)] = span
    best = anchors(words, window)
    alone = best == 0
    best[alone] = hashed[alone] >> np.uint64(6) | np.uint64(63 << 58)
    at = np.flatnonzero(valid)
    if not len(at):
        none = np.zeros(0, "i8")
        return {"row": none, "pos": none, "n": none, "anchor": none, "span": none}
    opens = np.append(True, (best[at[1:]] != best[at[:-1]]) | (at[1:] != at[:-1] + 1))
    nth = np.arange(len(at)) - np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
    opens |= nth % window == 0  # so that the first and last window cover a group
    head = np.flatnonzero(opens)
    tail = np.append(head[1:], len(at)) - 1
    n = tail - head + 1
    whole = mix(mix(hashed[at[head]] * M1 + hashed[at[tail]]) + n.astype("u8"))
    group = np.cumsum(opens) - 1
    for apart in range(1, window):  # periodic text: a window again within its group
        twice = np.flatnonzero(hashed[at[apart:]] == hashed[at[:-apart]])
        n[group[twice[group[twice] == group[twice + apart]]]] |= INNER
    return {"row": row[at[head]], "pos": place[at[head]], "n": n, "anchor": best[at[head]].view("i8"), "span": whole.view("i8")}


ROW = "kind tinyint, k bigint, s bigint, id bigint, tie int, pos int, n int"
FIELDS = ("kind", "k", "s", "id", "tie", "pos", "n")
TYPES = {"kind": "i1", "k": "i8", "s": "i8", "id": "i8", "tie": "i4", "pos": "i4", "n": "i4"}
#: Kinds of rows: to be compared; known to repeat an earlier group; shares its anchor with another group.
OPEN, REPEAT, SHARED = 0, 1, 2
#: Added to the count of an open group that holds a window twice: it is compared in any case.
INNER = 1 << 16


def _batches(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows["id"]), 1 << 16):
        yield pa.record_batch([pa.array(rows[f][i : i + (1 << 16)].astype(TYPES[f])) for f in FIELDS], list(FIELDS))


def _combined(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Before the shuffle: of equal groups in one batch only the first needs comparing, the others repeat it.

    Settled rows travel under a key of their own document, so a hot group does not meet in one task.
    """
    if not len(rows["k"]):  # no text of the batch has a window
        return rows | {"kind": np.zeros(0, "i1")}
    order = np.lexsort((rows["pos"], rows["tie"], rows["id"], rows["s"], rows["k"]))
    rows = {f: v[order] for f, v in rows.items()}
    again = np.append(False, (rows["k"][1:] == rows["k"][:-1]) & (rows["s"][1:] == rows["s"][:-1]))
    # an equal row of an exact copy of the document has the same place and repeats nothing
    place = [rows["id"], rows["tie"], rows["pos"]]
    firsts = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
    own = again & np.logical_and.reduce([v == v[firsts] for v in place])
    rows["kind"] = np.where(again, REPEAT, OPEN)
    rows["k"] = np.where(again, mix(rows["id"].astype("u8")).view("i8"), rows["k"])
    rows["s"] = np.where(again, 0, rows["s"])
    rows["n"] = np.where(again, rows["n"] & (INNER - 1), rows["n"])
    return {f: v[~own] for f, v in rows.items()}


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by anchor, span and place: all but the first of equal groups repeat; first ones
    that share their anchor with another span are kept for comparison. Holds one row between batches."""
    held: dict[str, np.ndarray] | None = None  # the last first row, not yet judged
    sibling = False
    for batch in batches:
        rows = {f: batch.column(i).to_numpy(zero_copy_only=False) for i, f in enumerate(FIELDS)}
        done = rows["kind"] == REPEAT
        if done.any():
            yield from _batches({f: v[done] for f, v in rows.items()})
            rows = {f: v[~done] for f, v in rows.items()}
        if not len(rows["k"]):
            continue
        if held is not None:
            rows = {f: np.concatenate([held[f], v]) for f, v in rows.items()}
        new = np.append(True, (rows["k"][1:] != rows["k"][:-1]) | (rows["s"][1:] != rows["s"][:-1]))
        start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        own = np.logical_and.reduce([rows[f] == rows[f][start] for f in ("id", "tie", "pos")])
        again = ~new & ~own
        if again.any():
            yield from _batches({f: v[again] for f, v in rows.items()} | {"kind": np.full(again.sum(), REPEAT), "n": rows["n"][again] & (INNER - 1)})
        first = {f: v[new] for f, v in rows.items()}
        like_next = first["k"][1:] == first["k"][:-1]
        shared = np.append(like_next, False) | np.append(False, like_next)
        shared |= first["n"] >= INNER
        first["n"] = first["n"] & (INNER - 1)
        shared[0] |= sibling and held is not None
        sibling = bool(shared[-1])
        held = {f: v[-1:] for f, v in first.items()}
        out = shared[:-1]
        if out.any():
            yield from _batches({f: v[:-1][out] for f, v in first.items()} | {"kind": np.full(out.sum(), SHARED)})
    if held is not None and sibling:
        yield from _batches(held | {"kind": np.full(1, SHARED)})


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with a last column, a struct that names and orders documents; null ids come last, equal ids in the order of a hash of their texts."""
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST))
    text = F.col(text_col).cast("string")
    repeated = docs.groupBy(key.alias("k")).count().filter("count > 1")
    tie = F.lit(0) if repeated.isEmpty() else (F.xxhash64(text) % (1 << 30)).cast("int")
    return docs.withColumn(fresh("repeat_key", docs), F.struct(key.alias("id"), tie.alias("tie"), text.alias("text")))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``id, tie, pos, n``: the ``n`` windows from word ``pos`` on occur earlier; each such window is in one row at least."""
    keyed = _keyed(docs, id_col, text_col)
    texts = keyed.select(F.col(keyed.columns[-1]).alias("r")).selectExpr("r.id as repeat_id", "r.tie as repeat_tie", "r.text as repeat_text").filter("repeat_text is not null")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            ids, ties = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            held, parts = as_bytes(batch.column(2)), []
            for first, last in slices(held):
                found = groups(held[first:last], window, cache)
                row = found.pop("row") + first
                parts.append({"k": found["anchor"], "s": found["span"], "id": ids[row], "tie": ties[row], "pos": found["pos"], "n": found["n"]})
            if parts:
                yield from _batches(_combined({f: np.concatenate([p[f] for p in parts]) for f in parts[0]}))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            ids, ties = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for i, (text, ranges) in enumerate(zip(as_bytes(batch.column(2)), batch.column(3).to_pylist())):
                words = np.fromiter(map(cache.__getitem__, space_words(text)), "u8")
                at = np.concatenate([np.arange(r >> 8, (r >> 8) + (r & 255)) for r in ranges])
                one, two = (window_hashes(words, window, seed)[at].view("i8") for seed in (1, 2))
                size = len(at)
                yield from _batches(_combined({"k": one, "s": two, "id": np.full(size, ids[i]), "tie": np.full(size, ties[i]), "pos": at, "n": np.ones(size, "i4")}))

    settle = lambda rows: rows.repartition("k").sortWithinPartitions("k", "s", "id", "tie", "pos").mapInArrow(_settle, ROW)
    judged = cut_lineage(settle(texts.mapInArrow(emit, ROW)))
    shared = judged.filter(F.col("kind") == SHARED).groupBy("id", "tie").agg(F.collect_list(_packed()).alias("ranges"))
    again = texts.join(
        shared.hint("shuffle_hash"), (F.col("repeat_id") == F.col("id")) & (F.col("repeat_tie") == F.col("tie"))
    ).select("id", "tie", "repeat_text", "ranges")
    one_by_one = settle(again.mapInArrow(windows, ROW))
    places = ("id", "tie", "pos", "n")
    return judged.filter(F.col("kind") == REPEAT).select(*places).unionByName(one_by_one.filter(F.col("kind") == REPEAT).select(*places))


def _packed() -> Column:
    """Place and count in one number; a group has at most ``WINDOW`` windows, far below 256."""
    return F.col("pos").cast("long") * 256 + F.col("n")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with a column ``repeats``: n_words, n_removed and kept, the words left, joined by one space.

    Words are runs of characters other than ASCII white space. A word goes if a window of ``window``
    words covers it whose sequence also starts earlier: in a document with a smaller id, or further up
    in the same one. Windows are judged on the input. Null and empty texts have no words. Null ids come
    after all others; different texts with one id are ordered by a hash of the text; exact repeats of a
    row are one document. Every row of ``docs`` is returned, with its columns; one named ``repeats`` is replaced.
    """
    if not 2 <= window < 256:
        raise ValueError("window must be from 2 to 255")
    found = repeated_windows(docs, id_col, text_col, window)
    ranges = found.groupBy("id", "tie").agg(F.collect_list(_packed()).alias("repeat_ranges"))

    @arrow_udf("struct<n_words:bigint,n_removed:bigint,kept:string>")
    def keep(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
        for texts, removed in batches:
            out = []
            for text, packed in zip(as_bytes(texts), removed.to_pylist()):
                words = space_words(text)
                if not packed:
                    out.append({"n_words": len(words), "n_removed": 0, "kept": b" ".join(words).decode()})
                    continue
                at = np.array(packed, "i8")
                depth = np.zeros(len(words) + 1, "i8")
                np.add.at(depth, at >> 8, 1)
                np.add.at(depth, (at >> 8) + (at & 255) - 1 + window, -1)
                gone = np.cumsum(depth)[:-1] > 0
                left = [words[i] for i in np.flatnonzero(~gone)]
                out.append({"n_words": len(words), "n_removed": int(gone.sum()), "kept": b" ".join(left).decode()})
            yield pa.array(out, kind)

    keyed = _keyed(docs, id_col, text_col)
    key, found_key = keyed.columns[-1], fresh("repeat_found", keyed)
    ranges = ranges.select(F.struct("id", "tie", F.col("repeat_ranges").alias("ranges")).alias(found_key))
    same = (F.col(f"{key}.id") == F.col(f"{found_key}.id")) & (F.col(f"{key}.tie") == F.col(f"{found_key}.tie"))
    joined = keyed.join(ranges.hint("shuffle_hash"), same, "left")
    return joined.select(*[keyed[c] for c in docs.columns if c != "repeats"], keep(F.col(f"{key}.text"), F.col(f"{found_key}.ranges")).alias("repeats"))


def brute_force(texts: list[str | None], window: int = WINDOW) -> pd.DataFrame:
    """The same by a dictionary of all windows, for texts in the order of their ids; for tests."""
    seen, rows = set(), []
    for text in texts:
        words, gone = space_words(text.encode() if text else None), set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone |= set(range(i, i + window))
            seen.add(key)
        rows.append((len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])
