"""Texts alike by five-word shingles, whatever their fingerprints say."""

import random

import numpy as np
import pytest

import corpus_pipeline
from corpusmap.llm import overlap, simhash


def brute(texts):
    """Class of each text, from all pairs of word sets."""
    sets = []
    for t in texts:
        words = t.lower().split() if t else []
        n = min(5, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set())
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def varied(seed=3):
    rng = random.Random(seed)
    line = " ".join(f"licence{i}" for i in range(40))
    texts = []
    for _ in range(30):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.choice([4, 12, 60, 150]))]
        for _ in range(rng.randrange(1, 7)):
            copy = list(words)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy) + (f" {line}" if rng.random() < 0.5 else ""))
    return texts + [texts[0].upper(), texts[5].replace(" ", "  "), "", " "]


@pytest.mark.parametrize("sample", [0, 2048])
def test_alike(spark, sample):
    texts = varied()
    want = sorted(set(brute(texts)))
    table = spark.createDataFrame([*enumerate(texts), (900, None), (901, None)], "doc_id bigint, text string").repartition(3)
    assert sorted(r.doc_id for r in overlap.one_of_each(table, sample=sample).collect()) == [*want, 900, 901]
    assert len(want) < len(set(simhash.brute_force(texts, list(range(len(texts)))).component_id))
    assert overlap.one_of_each(table.filter("false")).count() == 0


def test_sketches_rule_out_no_pair():
    """Turned bits never exceed the shingles that one of both texts has alone."""
    rng = np.random.default_rng(4)
    for n in (0, 1, 3, 63, 64, 65, 127, 128, 129, 700, 3000):
        a = rng.integers(0, 1 << 63, n).astype("u8")
        for drop, add in ((0, 0), (n // 9, 0), (0, n // 5), (n // 20, n // 20), (n, n)):
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, add).astype("u8")]))
            bits = overlap.turned(overlap.sketch(np.unique(a)), overlap.sketch(b))
            assert bits <= len(np.setxor1d(a, b))
            if drop == n > 60:
                assert bits > (len(a) + len(b)) / 9


def test_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (7, text + " end"), (7, "other words altogether here now"), (9, "other words altogether here now"), (9, text), (None, "alone")]
    found = overlap.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == sorted([(7, text + " end"), (7, "other words altogether here now"), (0, "alone")])


def test_pipeline_leaves_no_pair(spark):
    """Documents 6 and 145, and 1 and 177, of the smallest tables are alike, but more than 3 bits apart."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        if name.endswith("near_dedup"):
            docs = stage(spark, docs, "/root/testdata/sf0.001")
    left = docs.select("doc_id", "text").collect()
    assert len(set(brute([r.text for r in left]))) == len(left)
    assert {6, 1} <= {r.doc_id for r in left} and not {145, 177} & {r.doc_id for r in left}
