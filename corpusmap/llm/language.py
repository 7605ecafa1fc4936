"""Language of texts and of spans within them.

Ranges of scripts narrow the candidates of a word, character trigrams score it for each candidate,
and Viterbi with a penalty for every switch labels the spans of a text.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from corpusmap.llm.common import slices

#: First code points of script ranges and the script from there on; fixed values of Unicode.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B80, "Tamil"), (0x0C00, "Telugu"),
    (0x0E00, "Thai"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x3040, "Kana"),
    (0x3400, "Han"), (0xAC00, "Hangul"), (0xD800, "Other"),
)
STARTS = [start for start, _ in SCRIPTS]

PER_LANGUAGE = 3000
SWITCH, FLOOR = 12.0, -100.0
CACHE = 1 << 19
SLICE = 1 << 22
WORD = re.compile(r"[^\W\d_]+")


def script(word: str) -> int:
    return bisect_right(STARTS, ord(word[0])) - 1


def grams(word: str) -> Iterator[str]:
    padded = f"^{word}$"
    return (padded[i : i + 3] for i in range(len(padded) - 2))


def gram_codes(words: list[str]) -> np.ndarray:
    """Every trigram of all words in turn as one number; a word of n characters has n."""
    points = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype("i8")
    codes = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 2)
    inside = np.ones(len(points), bool)
    inside[ends - 1] = inside[ends - 2] = False
    return codes[inside[:-2]]


@dataclass
class Model:
    """Log-probabilities of trigrams given their first two characters, and the scripts of each language."""

    languages: list[str]
    codes: np.ndarray  # of all known trigrams, ascending
    tables: np.ndarray  # language, trigram; the last column stands for trigrams never seen
    fits: np.ndarray  # script range, language; true for all languages where none uses the script

    def scores(self, words: list[str]) -> np.ndarray:
        """A row for each word; languages of other scripts get far less than any that fits."""
        out = np.zeros((len(words), len(self.languages)))
        if not out.size:
            return out
        codes = gram_codes(words)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        at[self.codes[at] != codes] = len(self.codes)
        lengths = np.fromiter(map(len, words), "i8", len(words))
        heads = np.cumsum(lengths) - lengths
        for own, table in enumerate(self.tables):
            out[:, own] = np.add.reduceat(table[at], heads)
        first = np.searchsorted(STARTS, np.fromiter((ord(w[0]) for w in words), "i8", len(words)), "right") - 1
        known = self.fits[first].any(axis=1, keepdims=True)
        return np.where(self.fits[first], out, FLOOR * lengths[:, None]) * known


def fit(counts: list[tuple[str, str, int]], smoothing: float = 0.5) -> Model:
    """A model from counts by language and trigram."""
    languages = sorted({lang for lang, _, _ in counts})
    every = sorted({g for _, g, _ in counts}, key=lambda g: tuple(map(ord, g)))
    kinds = len({g[2] for g in every}) or 1
    place = {name: i for i, (_, name) in reversed(list(enumerate(SCRIPTS)))}
    groups = np.array([place[name] for _, name in SCRIPTS])  # ranges of one script share a group
    tables = np.full((len(languages), len(every) + 1), np.log(1 / kinds) - 2)
    fits = np.zeros((len(SCRIPTS), len(languages)), bool)
    for at, lang in enumerate(languages):
        own = {g: n for name, g, n in counts if name == lang}
        heads, used = Counter(), Counter()
        for g, n in own.items():
            heads[g[:2]] += n
            used[groups[script(g[1])]] += n
        tables[at, :-1] = [np.log((own.get(g, 0) + smoothing) / (heads[g[:2]] + smoothing * kinds)) for g in every]
        fits[:, at] = np.isin(groups, [s for s, n in used.items() if n >= 0.01 * sum(own.values())])
    codes = np.array([ord(g[0]) << 42 | ord(g[1]) << 21 | ord(g[2]) for g in every], "i8")
    return Model(languages, codes, tables, fits)


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit on at most ``per_language`` texts of each language, drawn by hash of the id, from rows that meet ``learn``.

    ``learn`` is a condition on ``id_col``. Rows with a null id, text or language are not learnt from.
    """
    ids = (
        docs.filter(learn & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())
        .select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"))
        .withColumn("h", F.xxhash64("id")).withColumn("bin", F.shiftright("h", 48))
    )
    # whole bins of hashes first: only those that reach into the draw are ranked, however many rows a language has
    below = F.sum("n").over(Window.partitionBy("lang").orderBy("bin")) - F.col("n")
    cut = ids.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n")).withColumn("below", below)
    cut = cut.filter(F.col("below") < per_language).groupBy("lang").agg(F.max("bin").alias("last"))
    # one small row per language, fewer than the model holds; joined so, rows beyond the draw are never shuffled
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    drawn = (
        ids.join(F.broadcast(cut), "lang").filter("bin <= last").withColumn("rank", rank)
        .filter(F.col("rank") <= per_language).select("id", "lang").distinct()
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in Counter(WORD.findall(text.as_py().lower())).items():
                    for g in grams(word):
                        found[lang, g] += n
        rows = sorted(found.items())
        yield pa.record_batch(
            [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())],
            ["lang", "gram", "n"],
        )

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text is not null")
    # the list of ids is bounded by languages times per_language
    counts = texts.join(F.broadcast(drawn), ["id", "lang"]).select("lang", "text").mapInArrow(count, "lang string, gram string, n bigint")
    return fit([tuple(r) for r in counts.groupBy("lang", "gram").agg(F.sum("n")).orderBy("lang", "gram").collect()])


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of every word, for texts one after the other in ``scores``; all texts advance together."""
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    size = scores.shape[1]
    value = np.zeros((len(lengths), size))
    came = np.zeros((len(scores), size), "i2")  # the language one word before
    active = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), "right")
    own = np.arange(size, dtype="i2")
    for t, live in enumerate(active):
        v, at = value[:live], starts[:live] + t
        if t:
            top = v.argmax(axis=1)
            other = v[np.arange(live), top] - switch
            stay = v >= other[:, None]
            came[at] = np.where(stay, own, top[:, None])
            v = np.where(stay, v, other[:, None])
        value[:live] = v + scores[at]
    label = np.zeros(len(scores), "i2")
    now = value.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        live = active[t]
        at = starts[:live] + t
        label[at] = now[:live]
        if t:
            now[:live] = came[at, now[:live]]
    return label


class Numbers(dict):
    """Row of each word in growing tables of scores and letters; ``settle`` fills the rows of new words."""

    def __init__(self, model: Model):
        self.model, self.new, self.settled = model, [], 0
        self.scores, self.letters = np.zeros((1024, len(model.languages))), np.zeros(1024, "i8")

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def settle(self) -> None:
        if len(self) > len(self.letters):
            more = 2 * len(self) - len(self.letters)
            self.scores, self.letters = np.pad(self.scores, ((0, more), (0, 0))), np.pad(self.letters, (0, more))
        rows = slice(self.settled, len(self))
        self.scores[rows] = self.model.scores(self.new)
        # the pattern also takes superscripts and fractions
        self.letters[rows] = [len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in self.new]
        self.new, self.settled = [], len(self)


def label(model: Model, texts: list[str | None], numbers: Numbers, switch: float = SWITCH, spans: bool = False) -> list[dict]:
    """Language, its share of the letters, and on request spans of each text."""
    ids, lengths = [], []
    for text in texts:
        found = WORD.findall(text.lower()) if text else []
        ids += map(numbers.__getitem__, found)
        lengths.append(len(found))
    if not model.languages:
        return [{"lang": "und", "score": 0.0, "spans": [] if spans else None} for _ in texts]
    numbers.settle()
    ids, lengths = np.array(ids, "i8"), np.array(lengths, "i8")
    letters = numbers.letters
    best = viterbi(numbers.scores[ids], lengths, switch)
    stops = np.cumsum(lengths)
    out = []
    for start, stop in zip(stops - lengths, stops):
        if start == stop:
            out.append({"lang": "und", "score": 0.0, "spans": [] if spans else None})
            continue
        weight = np.bincount(best[start:stop], letters[ids[start:stop]], len(model.languages))
        if not weight.any():
            out.append({"lang": "und", "score": 0.0, "spans": [] if spans else None})
            continue
        top = int(weight.argmax())
        row = {"lang": model.languages[top], "score": float(weight[top] / weight.sum()), "spans": None}
        if spans:
            heads = np.flatnonzero(np.append(True, np.diff(best[start:stop]) != 0))
            ends = np.append(heads[1:], stop - start)
            row["spans"] = [{"lang": model.languages[best[start + h]], "first_word": int(h), "n_words": int(e - h)} for h, e in zip(heads, ends)]
        out.append(row)
    return out


def identify(spark, model: Model, text: Column, switch: float = SWITCH, spans: bool = True) -> Column:
    """``lang, score, spans`` of each whole text.

    The language is the one with most letters over all spans, the first by name on a tie; the score is
    its share. A null text or one without letters is ``und`` with score 0. Scripts that no learnt language
    uses say nothing, so a text in such a script gets the first language by name. Rows are judged alone.
    """
    held = spark.sparkContext.broadcast(model)

    @arrow_udf("struct<lang:string,score:double,spans:array<struct<lang:string,first_word:bigint,n_words:bigint>>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        span = pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])
        numbers = Numbers(held.value)
        for batch in batches:
            texts, out = batch.to_pylist(), []
            for first, last in slices(texts, SLICE):
                if len(numbers) > CACHE:
                    numbers = Numbers(held.value)
                out += label(held.value, texts[first:last], numbers, switch, spans)
            yield pa.array(out, kind)

    return run(text.cast("string"))
