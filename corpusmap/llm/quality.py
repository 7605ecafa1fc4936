"""Quality rules: countable faults of a text, and hashed n-gram likelihood under trusted against raw text.

Words and pairs of neighbouring words (grams) fall into buckets by hash. Two multinomials over the buckets are
counted, one over trusted texts and one over the whole corpus; a text's score is the sum of its grams'
log-likelihood ratios over their number, so length doesn't count. Ratios are whole thousandths, sums are exact, and
every text is kept or not by one threshold: nothing is drawn at random.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, compress, count, islice

# the interpreter's own MD5 takes half the time of OpenSSL's on strings of a few bytes
from _md5 import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from corpusmap.llm.common import as_bytes, slices
from corpusmap.session import cut_lineage

BUCKETS = 1 << 16
SYMBOLS = b"#*$%&|<>"
#: Least words of a text; most hundredths of its words in repeated windows; words of such a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 50, 3
#: One in so many trusted texts may score below the threshold.
TRUSTED_BELOW = 200
FIELDS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, score bigint"


def buckets_of(grams: Iterable[bytes]) -> np.ndarray:
    """The first two bytes of each gram's MD5."""
    digests = b"".join([md5(g).digest() for g in grams])
    return np.frombuffer(digests, ">u2")[::8].astype("i8")


class Vocabulary:
    """Numbers and buckets of words, kept from one slice to the next up to a bound."""

    def __init__(self, most: int = 1 << 19):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = defaultdict(count().__next__)
        self.names: list[bytes] = []
        self.buckets = np.zeros(0, "i8")

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.names) > self.most:
            self.clear()
        ids = np.fromiter(map(self.number.__getitem__, words), "i8", len(words))
        new = list(islice(self.number, len(self.names), None))
        self.names += new
        self.buckets = np.append(self.buckets, buckets_of(new))
        return ids


class Grams:
    """Words of some texts as numbers, and the hash buckets of their words and pairs, text by text."""

    def __init__(self, texts: list[bytes | None], words: Vocabulary):
        split = [t.split() if t else [] for t in texts]
        self.lengths = np.array([len(w) for w in split], "i8")
        every = list(chain.from_iterable(split))
        self.ids = words.numbers(every)
        self.known = max(1, len(words.names))
        self.text = np.repeat(np.arange(len(texts)), self.lengths)
        inside = self.text[1:] == self.text[:-1]
        pairs = map(b" ".join, compress(zip(every, islice(every, 1, None)), inside.tolist()))
        self.buckets = np.concatenate([words.buckets[self.ids], buckets_of(pairs)])
        self.gram_text = np.concatenate([self.text, self.text[:-1][inside]])

    def repeated_words(self) -> np.ndarray:
        """Per text, the words in windows that stand in it twice or more."""
        ids, known = self.ids, self.known
        if known >= 1 << 21:  # a window's three numbers have to fit into one
            ids = np.unique(ids, return_inverse=True)[1]
            known = int(ids.max(initial=0)) + 1
        if known < 1 << 21:
            windows = (ids[:-2] * known + ids[1:-1]) * known + ids[2:]
        else:
            windows = np.unique(ids[:-2] * known + ids[1:-1], return_inverse=True)[1] * known + ids[2:]
        out = np.zeros(len(self.lengths), "i8")
        ends = np.cumsum(self.lengths)
        for i, (end, n) in enumerate(zip(ends.tolist(), self.lengths.tolist())):
            own = windows[end - n : max(end - n, end - 2)]
            ranked = np.sort(own)
            twice = ranked[1:][ranked[1:] == ranked[:-1]]
            if len(twice):
                again, covered = np.isin(own, twice), np.zeros(n, bool)
                for k in range(WINDOW):
                    covered[k : k + len(own)] |= again
                out[i] = covered.sum()
        return out


@dataclass
class Model:
    """Thousandths of log-likelihood ratio per bucket."""

    weights: np.ndarray

    def measure(self, texts: list[bytes | None], words: Vocabulary) -> list[np.ndarray]:
        """The values of ``FIELDS`` for some texts; the score of a text without a gram is 0."""
        grams = Grams(texts, words)
        number = np.bincount(grams.gram_text, minlength=len(texts))
        total = np.bincount(grams.gram_text, self.weights[grams.buckets], minlength=len(texts)).astype("i8")
        chars, symbols, lines = (np.zeros(len(texts), "i8") for _ in range(3))
        for i, text in enumerate(texts):
            if text:
                packed = b"".join(text.split())
                chars[i] = len(packed.decode())
                symbols[i] = len(packed) - len(packed.translate(None, SYMBOLS))
                whole = [line for line in text.split(b"\n") if line.strip()]
                lines[i] = len(whole) - len(set(whole))
        return [grams.lengths, chars, symbols, lines, grams.repeated_words(), total // np.maximum(number, 1)]


def ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of both multinomials, each count raised by one."""
    p = (target + 1.0) / (target.sum() + BUCKETS)
    q = (raw + 1.0) / (raw.sum() + BUCKETS)
    return np.rint(1000 * np.log(p / q)).astype("i8")


def train(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Counts over every text: all of them, and those whose id stands in ``trusted``.

    Each task hands on at most ``BUCKETS`` sums, so what is shuffled follows the number of tasks and what the driver
    gets has a fixed size. A null id is not trusted. Without trusted texts every ratio is that of an empty count.
    """
    marks = trusted.select(F.col(id_col).alias("id"), F.lit(0).alias("part")).filter("id is not null").distinct().withColumn("mark", F.lit(1))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    # rows without an id match nothing and go anywhere
    rows = rows.withColumn("part", F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(0))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, words = np.zeros((2, BUCKETS), "i8"), Vocabulary()
        for batch in batches:
            texts, marked = as_bytes(batch.column(1)), batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(bool)
            for i, j in slices(texts):
                grams = Grams(texts[i:j], words)
                totals[0] += np.bincount(grams.buckets[marked[i:j][grams.gram_text]], minlength=BUCKETS)
                totals[1] += np.bincount(grams.buckets, minlength=BUCKETS)
        used = np.flatnonzero(totals[1])
        yield pa.record_batch([pa.array(x) for x in (used, totals[0][used], totals[1][used])], ["bucket", "target", "raw"])

    # texts always travel once, whatever the size of the list of ids; no text is sorted
    counted = rows.join(marks.hint("shuffle_hash"), ["id", "part"], "left").select("mark", "text").mapInArrow(sums, "bucket bigint, target bigint, raw bigint")
    found = counted.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toArrow()
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = found.column("bucket").to_numpy()
    target[at], raw[at] = found.column("target").to_numpy(), found.column("raw").to_numpy()
    return Model(ratios(target, raw))


def measures(spark: SparkSession, model: Model, text: Column) -> Column:
    """A struct of ``FIELDS`` for each whole text; a null text counts as empty."""
    held = spark.sparkContext.broadcast(model)
    kinds = [pa.field(part.split()[0], pa.int64()) for part in FIELDS.split(", ")]

    @arrow_udf("struct<" + FIELDS.replace(" bigint", ":bigint") + ">")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Vocabulary()
        for batch in batches:
            texts, parts = as_bytes(batch), []
            for i, j in slices(texts):
                parts.append(pa.StructArray.from_arrays([pa.array(c) for c in held.value.measure(texts[i:j], words)], fields=kinds))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct(kinds))

    return measure(text.cast("string"))


def assess(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", below: int = TRUSTED_BELOW) -> DataFrame:
    """``id_col``, the columns of ``FIELDS``, ``base_failed`` and ``kept`` for every row of ``docs``.

    ``base_failed``: fewer than 50 words, or over half of them in windows of three that the text repeats.
    ``kept``: not failed, and a score of at least the threshold, the lowest score that all but one in ``below`` of the
    trusted texts that don't fail reach. Without such texts the score decides nothing. Null and empty texts have no word
    and fail. Equal texts get equal values; a repeated id's rows are each judged by their own text and each count as trusted
    where the id is. Other columns are not read, so their names don't matter. Rows need no order.
    """
    spark = docs.sparkSession
    model = train(docs, trusted, id_col, text_col)
    found = docs.select(F.col(id_col).alias("id"), measures(spark, model, F.col(text_col)).alias("m")).select("id", "m.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    scored = cut_lineage(found.withColumn("base_failed", failed))
    ids = trusted.select(F.col(id_col).alias("id")).distinct()
    # scores are whole thousandths between bounds that the counts set, so the histogram is short
    bins = scored.filter("not base_failed").join(ids, "id", "left_semi").groupBy("score").count().orderBy("score").collect()
    skip, least = sum(b["count"] for b in bins) // below, None
    for row in bins:
        least = row.score
        skip -= row["count"]
        if skip < 0:
            break
    passes = F.lit(True) if least is None else F.col("score") >= least
    return scored.withColumn("kept", ~F.col("base_failed") & passes).withColumnRenamed("id", id_col)
