"""Lyndon arrays and runs against their definitions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmap.llm import runs


def brute(s):
    """All runs, by comparing every shift at every place."""
    out = {}
    for q in range(1, len(s) // 4 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((i, n, q) for (i, n), q in out.items()), key=lambda r: (r[0], r[2]))


def sequences(seed, number):
    rng = random.Random(seed)
    for _ in range(number):
        s = [rng.randrange(rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randrange(40))]
        if rng.random() < 0.7 and s:
            root, at = s[: rng.randrange(1, 8)], rng.randrange(len(s))
            s = s[:at] + (root * 9)[: rng.randrange(50)] + s[at:]
        yield s


def test_lyndon_arrays():
    for s in sequences(1, 400):
        for order in (s, [-x for x in s]):
            sizes, group = runs.lyndon(order)
            for i in range(len(s)):
                least = lambda n: all(order[i : i + n] < order[i + k : i + n] for k in range(1, n))  # noqa: E731, B023
                assert sizes[i] == next(n for n in range(len(s) - i, 0, -1) if least(n))
            words = [tuple(order[i : i + n]) for i, n in enumerate(sizes)]
            assert len(set(zip(words, group))) == len(set(words)) == len(set(group))


def test_runs():
    for s in sequences(2, 1500):
        words = [b"%d" % x for x in s]
        assert runs.find_runs([words, [], words])[2] == brute(s)
        assert sorted(runs.runs_of(np.array(s, "i8")), key=lambda r: (r[0], r[2])) == brute(s)


def test_column(spark):
    texts = ["a b " * 9 + "c", None, "", " \n\t", "x y", "b a a a a a a b", "a " * 6, "a " * 5, "\x1f\x1f \x1f\x1f", "one two three four " * 3]
    table = spark.createDataFrame([(None if i % 3 else i, t, "r") for i, t in enumerate(texts * 2)], "doc_id int, text string, runs string").repartition(3)
    found = table.select("text", runs.periodic(F.col("text")).alias("f")).collect()
    assert len(found) == 2 * len(texts)
    for row in found:
        words = (row.text or "").split(" ") if row.text != " \n\t" else []
        words = [w for w in words if w]
        want = brute(words)
        assert [tuple(r) for r in row.f.runs] == want and row.f.n_words == len(words)
        gone = {p for i, n, q in want for p in range(i + q, i + n)}
        assert row.f.collapsed == " ".join(w for p, w in enumerate(words) if p not in gone)
    assert table.filter("false").select(runs.periodic(F.col("text"))).count() == 0


@pytest.mark.parametrize("words", [["w"] * 300_000, [f"w{i % 1000}" for i in range(300_000)], [f"w{i * i % 9973}" for i in range(300_000)]])
def test_very_long(words):
    (found,) = runs.find_runs([[w.encode() for w in words]])
    for start, length, q in found:
        assert words[start : start + length - q] == words[start + q : start + length]
    period = next(q for q in range(1, 10_000) if words[:-q] == words[q:])
    assert (0, len(words), period) in found
