"""Prefixes leave out shingles that a small share of many texts have."""

import numpy as np
from pyspark.sql import functions as F

from corpusmap.llm import overlap


def test_passages_of_few_texts_are_not_met(spark, monkeypatch):
    """12,000 texts of own words; each of 1,000 passages is in twelve of them, too few for a sample to tell."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(12_000):
        words = [f"w{n}" for n in rng.integers(10**9, size=16)]
        words[6:11] = [f"passage{i % 1000}-{j}" for j in range(5)]
        rows.append((i, " ".join(words)))
    rows.append((20_000, rows[7][1] + " more"))
    met, before = [], overlap.buckets

    def counted(prefixes):
        most = prefixes.groupBy("s").agg(F.countDistinct("key").alias("n")).filter("n > 6")
        met.append(most.count())
        return before(prefixes)

    monkeypatch.setattr(overlap, "buckets", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert overlap.near_classes(docs).count() == 2
    assert met == [0]
