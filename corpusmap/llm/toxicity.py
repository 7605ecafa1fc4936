"""Toxicity by non-negative positive-unlabelled learning.

Positives are texts confirmed as toxic; all other text is unlabelled, toxic or not. With the class
prior p, the risk of calling unlabelled text clean is corrected by the share of it that positives
explain, and the corrected part is kept from going below zero (Kiryo et al., 2017).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusmap.llm.common import alnum_words, as_bytes
from corpusmap.operators.rows import hash_order, smallest

BUCKETS = 1 << 20
#: Standard errors by which the share of positives with a word must differ, and how many words are used in any case.
TELLING, LEAST_FEATURES = 4.0, 16
#: Bytes of a word's beginning that count as features.
PREFIXES = (4, 5, 6)
#: Bounds of the sample that the classifier is fitted on, and of its features.
POSITIVES, UNLABELLED, FEATURES = 3000, 9000, 1024


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether the row's fold, by the CRC-32 of its id as text, is ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def buckets(text: bytes | None) -> set[int]:
    """Hashed distinct words of a whole text, and hashed beginnings, which inflected forms share."""
    words = set(alnum_words(text))
    found = {crc32(w) % BUCKETS for w in words}
    for width in PREFIXES:
        found |= {crc32(w, width) % BUCKETS for w in {w[:width] for w in words}}
    return found


@dataclass
class Model:
    """Weights of the chosen word buckets and the bias."""

    weights: dict[int, float]
    bias: float

    def score(self, text: bytes | None) -> float:
        get, margin = self.weights.get, self.bias
        for bucket in buckets(text):
            margin += get(bucket, 0.0)
        return float(1 / (1 + np.exp(-np.clip(margin, -60, 60))))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, features: int = FEATURES, epochs: int = 60, rate: float = 0.05, decay: float = 1e-4, seed: int = 0) -> Model:
    """Minimise the non-negative risk with the sigmoid loss by Adam over the most telling words."""
    if not positive or not unlabelled:
        return Model({}, -30.0 if not positive else float(np.log(prior / (1 - prior))))

    def count(rows: list[np.ndarray]) -> np.ndarray:
        total = np.zeros(BUCKETS, "i8")
        for i in range(0, len(rows), 256):  # the driver holds numbers of few rows twice
            total += np.bincount(np.concatenate(rows[i : i + 256]), minlength=BUCKETS)
        return total

    p, u = count(positive) / len(positive), (count(unlabelled) + 0.5) / (len(unlabelled) + 1)
    lift = np.abs(p - u) / np.sqrt(u * (1 - u) / len(positive) + 1e-12)
    # words that may differ by chance only would outweigh the telling ones by their number
    chosen = np.argsort(-lift, kind="stable")[: max(LEAST_FEATURES, min(features, int((lift >= TELLING).sum())))]
    place = np.full(BUCKETS, -1, "i4")
    place[chosen] = np.arange(len(chosen))

    def matrix(rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(rows), len(chosen)), "u1")
        for i, row in enumerate(rows):
            at = place[row]
            out[i, at[at >= 0]] = 1
        return out

    xp, xu, random = matrix(positive), matrix(unlabelled), np.random.default_rng(seed)
    w, b = np.zeros(len(chosen), "f4"), np.float32(-1.0)
    m, v, step = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0
    blocks = max(1, len(xu) // 2048)
    for _ in range(epochs):
        for up, uu in zip(np.array_split(random.permutation(len(xp)), blocks), np.array_split(random.permutation(len(xu)), blocks)):
            if not len(up) or not len(uu):
                continue
            bp, bu = xp[up].astype("f4"), xu[uu].astype("f4")
            sp, su = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) for x in (bp, bu))
            # sigmoid loss: of calling x positive 1 - s, of calling it negative s; both have slope s (1 - s)
            negative_risk = su.mean() - prior * sp.mean()
            gp, gu = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
            if negative_risk >= 0:
                grads = (-prior - prior, 1.0)
            else:  # step back from fitting the unlabelled texts too well
                grads = (prior, -1.0)
            dp, du = grads[0] * gp, grads[1] * gu
            gradient = np.append(bp.T @ dp + bu.T @ du + decay * w, dp.sum() + du.sum())
            step += 1
            m = 0.9 * m + 0.1 * gradient
            v = 0.999 * v + 0.001 * gradient**2
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w, b = w - move[:-1].astype("f4"), b - np.float32(move[-1])
    return Model({int(k): float(x) for k, x in zip(chosen, w) if x}, float(b))


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    prior: float | None = None, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> Model:
    """Fit on at most ``positives`` confirmed toxic texts and ``unlabelled`` other ones, both drawn by hash of the id.

    ``learn`` is a condition on ``id_col``; only rows that meet it are used. ``prior`` is the share
    of toxic text; by default that among the labelled rows, kept within 0.01 and 0.5. The two lists
    of ids are all that is sent to the executors. Null ids, labels and texts are not learnt from;
    without positives every text gets a score near 0.
    """
    known = labels.filter(learn & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if prior is None:
        prior = known.agg(F.avg(F.col(label_col).cast("double"))).first()[0] or 0.0
        prior = min(max(prior, 0.01), 0.5)
    drawn = lambda rows, most: smallest(rows.select(id_col).distinct(), most, hash_order(id_col))
    toxic = drawn(known.filter(F.col(label_col) == 1), positives).withColumn("kind", F.lit(1))
    other = drawn(docs.filter(learn & F.col(id_col).isNotNull()), unlabelled).withColumn("kind", F.lit(0))
    wanted = toxic.unionByName(other).groupBy(id_col).agg(F.max("kind").alias("kind"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted(buckets(t)) for t in as_bytes(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], ["kind", "words"])

    found = (
        docs.select(id_col, F.col(text_col).cast("string").alias("text")).filter("text is not null")
        .join(F.broadcast(wanted), id_col).select("kind", "text")
        .mapInArrow(features, "kind int, words array<int>").toArrow()
    )
    kinds, rows = found.column("kind").to_numpy(), []
    words = offsets = values = None
    for words in found.column("words").chunks:
        offsets, values = words.offsets.to_numpy(), words.values.to_numpy()
        rows += [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    order = sorted(range(len(rows)), key=lambda i: rows[i].tobytes())  # the same model whatever order rows arrive in
    model = fit([rows[i] for i in order if kinds[i] == 1], [rows[i] for i in order if kinds[i] == 0], prior)
    del found, rows, words, offsets, values
    pa.default_memory_pool().release_unused()
    return model


def toxicity(spark, model: Model, text: Column) -> Column:
    """Score from 0 to 1 of each whole text; null and empty texts get the bias alone. Rows are judged alone."""
    held = spark.sparkContext.broadcast(model)

    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([held.value.score(t) for t in as_bytes(batch)], pa.float64())

    return score(text.cast("string"))
