"""Periodic runs of a word sequence, from Lyndon arrays that a suffix sorter's grouping phase leaves behind.

Baier's first phase groups suffixes by their first symbol and goes through the groups from the highest to the lowest. Each
suffix of a group points to its nearest suffix to the left that is in a lower group; the suffixes pointed to are moved, by
how often they are, to new groups right above their old one, and the group's common prefix is appended to theirs as often.
When a group's turn comes its prefix is the longest Lyndon word at each of its places: the phase yields the Lyndon array,
and two places with equal Lyndon words are in one group. Done under the given order and under its reverse, every run has
all its inner roots among the Lyndon words of one of both (Bannai et al.). A chain of equal neighbouring roots is
extended to both sides by the common prefixes and suffixes with its shift of one period; each side is shorter than it.

A run here repeats its smallest period at least ``LEAST_EXPONENT`` times and has ``LEAST_LENGTH`` words, so every window of
three of its words stands in it three times at least. Words outside such windows are taken away first, in a few rounds;
this loses no run and leaves ordinary prose nearly nothing to sort.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from corpusmap.llm.common import as_bytes, space_words

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
RESULT = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUN = pa.struct([pa.field(name, pa.int64()) for name in ("start", "length", "period")])


def lyndon(symbols: list[int]) -> tuple[list[int], list[int]]:
    """The length of the longest Lyndon word at each place, and a number that is equal just where these words are."""
    n = len(symbols)
    by_symbol: dict[int, set[int]] = defaultdict(set)
    for i, s in enumerate(symbols):
        by_symbol[s].add(i)
    keys = sorted(by_symbol)
    # groups in a list from low to high; group 0 stands below all
    members = [set(), *(by_symbol[k] for k in keys)]
    length = [0] + [1] * len(keys)
    lower, upper = [0, *range(len(keys))], [*range(1, len(keys) + 1), 0]
    rank = {k: g for g, k in enumerate(keys, 1)}
    group = [rank[s] for s in symbols]
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))  # neighbours among the suffixes whose turn is to come
    sizes, top = [0] * n, len(keys)
    while top:
        size = length[top]
        pointed: dict[int, int] = {}
        for i in sorted(members[top]):  # leftmost first, so that no member's left neighbour is a member
            sizes[i] = size
            left, right = before[i], after[i]
            if left >= 0:
                after[left] = right
                pointed[left] = pointed.get(left, 0) + 1
            if right < n:
                before[right] = left
        parts: dict[tuple[int, int], list[int]] = defaultdict(list)
        for i, times in pointed.items():
            parts[group[i], times].append(i)
        under = None
        for old, times in sorted(parts):
            part = parts[old, times]
            if old != under:
                under = place = old
            if len(part) == len(members[old]):
                # nothing would stay behind: what stood above because of fewer pointers changes places with it
                members[old].clear()
            else:
                members[old].difference_update(part)
            g = len(members)
            members.append(set(part))
            length.append(length[old] + times * size)
            above = upper[place]
            lower.append(place)
            upper.append(above)
            upper[place] = g
            if above:
                lower[above] = g
            for i in part:
                group[i] = g
            place = g
        top = lower[top]
        while top and not members[top]:
            top = lower[top]
    return sizes, group


def _matching(left: np.ndarray, right: np.ndarray) -> int:
    """How many items agree from the start on."""
    most, done, step = min(len(left), len(right)), 0, 16
    while done < most:
        end = min(most, done + step)
        differ = left[done:end] != right[done:end]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done, step = end, 2 * step
    return most


def runs_of(ids: np.ndarray) -> set[tuple[int, int, int]]:
    """``start, length, period`` of all runs of a sequence of whole numbers."""
    found: set[tuple[int, int, int]] = set()
    n = len(ids)
    if n < LEAST_LENGTH:
        return found
    for order in (ids, -ids):
        sizes, group = (np.array(x, "i8") for x in lyndon(order.tolist()))
        at = np.arange(n)
        onto = at + sizes
        equal = np.zeros(n + 1, bool)
        inside = onto < n
        equal[:n][inside] = group[onto[inside]] == group[inside]
        back = at - sizes
        first = equal[:n] & equal[np.minimum(onto, n)] & ~((back >= 0) & (group[np.maximum(back, 0)] == group))
        for i in np.flatnonzero(first).tolist():
            period, end = int(sizes[i]), i
            while equal[end]:
                end += period
            end += period
            left = _matching(ids[:i][::-1], ids[: i + period][::-1][: i])
            right = _matching(ids[end:], ids[end - period :])
            length = end + right - (i - left)
            if length >= max(LEAST_LENGTH, LEAST_EXPONENT * period):
                found.add((i - left, length, period))
    return found


def stretches(ids: np.ndarray, text: np.ndarray, rounds: int = 4) -> list[tuple[int, int]]:
    """Ranges of words outside which no run has a word: their windows of three stand three times in the range."""
    start = np.flatnonzero(text[2:] == text[:-2]) if len(ids) > 2 else np.zeros(0, "i8")
    if not len(start):
        return []
    known = int(ids.max()) + 1
    _, pair = np.unique(ids[start] * known + ids[start + 1], return_inverse=True)
    _, window = np.unique(pair * known + ids[start + 2], return_inverse=True)
    part = text[start]
    for _ in range(rounds):
        key = window * (int(part.max()) + 1) + part
        _, same, times = np.unique(key, return_inverse=True, return_counts=True)
        keep = times[same] >= 3
        start, window, part = start[keep], window[keep], part[keep]
        if not len(start):
            return []
        part = np.cumsum(np.concatenate([[False], (np.diff(start) > 1) | (np.diff(part) != 0)]))
        if keep.all():
            break
    edge = np.flatnonzero(np.diff(part)) + 1
    lo, hi = np.concatenate([[0], edge]), np.concatenate([edge, [len(start)]])
    return [(int(start[a]), int(start[b - 1]) + 3) for a, b in zip(lo, hi) if start[b - 1] + 3 - start[a] >= LEAST_LENGTH]


def find_runs(words: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """All runs of each of some word sequences, by start, then period."""
    number = np.array([len(w) for w in words], "i8")
    names: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter((names[w] for one in words for w in one), "i8", int(number.sum()))
    text, first = np.repeat(np.arange(len(words)), number), np.cumsum(number) - number
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for a, b in stretches(ids, text):
        doc = int(text[a])
        shift = a - int(first[doc])
        out[doc] += [(s + shift, length, q) for s, length, q in runs_of(ids[a:b])]
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if runs else words)


def periodic(text: Column) -> Column:
    """``struct<n_words, runs, collapsed>`` of each whole text.

    A run is a stretch of words with smallest period q and at least max(6, 4q) words that goes on to neither side; runs come by
    start, then period. ``collapsed`` has the words that no run holds after its first q words, joined by one space.
    A null, empty or blank text has no word, no run and an empty ``collapsed``. Every row is judged alone, so repeated
    rows and ids, their order and other columns don't matter. A text is sorted in one piece, in memory of its own size.
    """
    kind = pa.struct([pa.field("n_words", pa.int64()), pa.field("runs", pa.list_(RUN)), pa.field("collapsed", pa.string())])

    @arrow_udf(f"struct<n_words:bigint,runs:{RESULT},collapsed:string>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            words = [space_words(t) for t in as_bytes(batch)]
            found, held, some = [], 0, []
            for one in words:  # sequences are numbered together, up to a bound
                some.append(one)
                held += len(one)
                if held > 1 << 18:
                    found += find_runs(some)
                    held, some = 0, []
            found += find_runs(some)
            runs = [[{"start": s, "length": n, "period": q} for s, n, q in one] for one in found]
            texts = [kept(w, r).decode() for w, r in zip(words, found)]
            columns = [pa.array(map(len, words), pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(texts, pa.string())]
            yield pa.StructArray.from_arrays(columns, fields=list(kind))

    return find(text.cast("string"))
