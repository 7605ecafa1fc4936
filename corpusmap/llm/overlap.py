"""Pairs of texts whose sets of word shingles are alike, found by prefixes of a shared order.

All shingles have one order: by how often the bin of their hash is met in all texts, then by hash. Two sets with
Jaccard similarity t or more share a shingle among the first ``n - ceil(t * n) + 1`` of each, so
joining these prefixes loses no pair, whatever the counts say; they only keep the buckets small.
Texts stay where they are: a text is a 64-bit number, and a shingle's bucket is a stretch of sorted rows that a task reads
as a stream, handing on only buckets with two texts or more. Candidates first meet by parity sketches, a few bytes for a
hundred shingles: each shingle that only one of two texts has turns one bit, so more turned bits than unlike shingles
allowed rule a pair out, and never a wrong one. What is left is verified on whole texts, and what is linked is named by MD5, so equal numbers of different texts only add candidates. Each bucket first compares its smallest
member with the others; what that links is not compared again, so a large family costs its size, not its square. What
is left of a bucket is compared block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusmap.llm.common import LOWER, as_bytes, fresh, slices, space_words
from corpusmap.operators.components import connected_components
from corpusmap.session import cut_lineage, discard

SHINGLE, ALIKE = 5, Fraction(4, 5)
#: Bins of hashes, a power of two, in which shingles are counted.
BINS = 1 << 20
#: Texts that a task remembers to leave out copies; rows of a bucket in one block.
REMEMBERED, BLOCK_ROWS = 1 << 18, 1024
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9], "u8")


def shingles(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of the lower-cased shingles of a whole text; a shorter text is one shingle."""
    words = space_words(text.translate(LOWER)) if text else []
    if not words:
        return np.zeros(0, "u8")
    seen: dict[bytes, int] = {}
    hash_of = xxhash.xxh64_intdigest
    for word in set(words):
        seen[word] = hash_of(word, 42)
    hashes, width = np.fromiter(map(seen.__getitem__, words), "u8", len(words)), min(shingle, len(words))
    out = np.zeros(len(words) - width + 1, "u8")
    for k in range(width):
        out = (out ^ hashes[k : k + len(out)]) * MIX[0]
        out = (out ^ (out >> np.uint64(29))) * MIX[1]
        out ^= out >> np.uint64(32)
    return np.unique(out * MIX[2])


def alike(a: np.ndarray, b: np.ndarray, least: Fraction = ALIKE) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and both * least.denominator >= least.numerator * (len(a) + len(b) - both)


def similar(least: Fraction, shingle: int):
    """Whether two whole texts are alike, as a column function."""

    @arrow_udf("boolean")
    def compare(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            yield pa.array([alike(shingles(a, shingle), shingles(b, shingle), least) for a, b in zip(as_bytes(left), as_bytes(right))], pa.bool_())

    return compare


def numbered(docs: DataFrame, text_col: str) -> DataFrame:
    """``key, other, text``: two 64-bit hashes of every text; null texts are left out."""
    text = F.col(text_col).cast("string")
    return docs.select(F.xxhash64(text).alias("key"), F.xxhash64(F.lit(1), text).alias("other"), text.alias("text")).filter("text is not null")


def counted(texts: DataFrame, shingle: int, bins: int) -> np.ndarray:
    """How many shingles of all texts of ``key, other, text`` fall into each bin; copies that one task meets count once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(bins, "i8"), set()
        for batch in batches:
            names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            texts = as_bytes(batch.column(2))
            if len(seen) > REMEMBERED:
                seen.clear()
            for i, j in slices(texts):
                own = []
                for k in range(i, j):
                    if names[k] not in seen:
                        seen.add(names[k])
                        own.append(shingles(texts[k], shingle) & np.uint64(bins - 1))
                if own:
                    total += np.bincount(np.concatenate(own).astype("i8"), minlength=bins)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held.astype("i4")), pa.array(total[held])], ["bin", "n"])

    found = texts.select("key", "other", "text").mapInArrow(count, "bin int, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(bins, "i4")
    out[found["bin"].to_numpy()] = np.minimum(found["n"].to_numpy(), np.iinfo("i4").max)
    return out


def prefixes(texts: DataFrame, shingle: int, least: Fraction, bins: int) -> DataFrame:
    """``s, key, size, pos``: the first shingles of each of ``key, other, text``; copies that one task meets count once."""
    held = texts.sparkSession.sparkContext.broadcast(counted(texts, shingle, bins))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = held.value
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            names = list(zip(keys.tolist(), batch.column(1).to_pylist()))
            texts = as_bytes(batch.column(2))
            if len(seen) > REMEMBERED:
                seen.clear()
            for i, j in slices(texts):
                parts, sizes, whose = [], [], []
                for k in range(i, j):
                    if names[k] in seen:
                        continue
                    seen.add(names[k])
                    own = shingles(texts[k], shingle)
                    own = own[np.argsort(count[(own & np.uint64(bins - 1)).astype("i8")], kind="stable")]
                    parts.append(own[: len(own) - ceil(least * len(own)) + 1])
                    sizes.append(len(own))
                    whose.append(k)
                taken = np.array([len(part) for part in parts], "i8")
                pos = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
                s = np.concatenate([*parts, np.zeros(0, "u8")]).view("i8")
                columns = [s, np.repeat(keys[whose], taken), np.repeat(np.array(sizes, "i4"), taken), pos.astype("i4")]
                yield pa.record_batch([pa.array(c) for c in columns], ["s", "key", "size", "pos"])

    return texts.select("key", "other", "text").mapInArrow(first, "s bigint, key bigint, size int, pos int")


def buckets(rows: DataFrame) -> DataFrame:
    """``s, key, size, pos, hub, hub_size, hub_pos`` of every row whose shingle an earlier text, the hub, has too."""
    names = ("s", "key", "size", "pos")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the hub of the last bucket, and the last row
        for batch in batches:
            if not batch.num_rows:
                continue
            part = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(names)}
            if last is not None:
                part = {n: np.concatenate([last[n], v]) for n, v in part.items()}
            opens = np.append(True, part["s"][1:] != part["s"][:-1])
            hub = np.maximum.accumulate(np.where(opens, np.arange(len(opens)), 0))
            again = np.append(False, np.logical_and.reduce([part[n][1:] == part[n][:-1] for n in names]))
            out = ~opens & ~again & ~((part["key"] == part["key"][hub]) & (part["size"] == part["size"][hub]))
            if last is not None:
                out[: len(last["s"])] = False
            at, to = np.flatnonzero(out), hub[out]
            if len(at):
                columns = [part[n][at] for n in names] + [part[n][to] for n in names[1:]]
                yield pa.record_batch([pa.array(c) for c in columns], [*names, "hub", "hub_size", "hub_pos"])
            keep = [hub[-1]] if hub[-1] == len(hub) - 1 else [hub[-1], len(hub) - 1]
            last = {n: v[keep] for n, v in part.items()}

    sorted_rows = rows.repartition("s").sortWithinPartitions(*names)
    return sorted_rows.mapInArrow(meet, "s bigint, key bigint, size int, pos int, hub bigint, hub_size int, hub_pos int")


def sketch(own: np.ndarray) -> bytes:
    """Parities of distinct hashes by their low bits; one to two bits for each hash, a power of two of them."""
    bits = max(64, 1 << int(len(own) - 1).bit_length()) if len(own) else 64
    return np.packbits(np.bincount(own & np.uint64(bits - 1), minlength=bits).astype("u1") & 1, bitorder="little").tobytes()


def turned(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ; the longer one is folded."""
    while len(a) != len(b):
        longer, shorter = (a, b) if len(a) > len(b) else (b, a)
        half = len(longer) // 2
        a, b = (int.from_bytes(longer[:half], "little") ^ int.from_bytes(longer[half:], "little")).to_bytes(half, "little"), shorter
    return (int.from_bytes(a, "little") ^ int.from_bytes(b, "little")).bit_count()


def sketches(texts: DataFrame, shingle: int) -> DataFrame:
    """``key, size, bits`` of each of ``key, other, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for i, j in slices(texts):
                own = [shingles(t, shingle) for t in texts[i:j]]
                columns = [batch.column(0).slice(i, j - i), pa.array(map(len, own), pa.int32()), pa.array(map(sketch, own), pa.binary())]
                yield pa.record_batch(columns, ["key", "size", "bits"])

    return texts.select("key", "text").mapInArrow(run, "key bigint, size int, bits binary").distinct()


def possible(least: Fraction):
    """Whether sketches and sizes leave it open that two texts are alike, as a column function."""
    loss, whole = least.denominator - least.numerator, least.denominator + least.numerator

    @arrow_udf("boolean")
    def compare(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for n, a, m, b in batches:
            rows = zip(n.to_pylist(), a.to_pylist(), m.to_pylist(), b.to_pylist())
            yield pa.array([turned(x, y) * whole <= loss * (p + q) for p, x, q, y in rows], pa.bool_())

    return compare


def near_classes(
    docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, least: Fraction = ALIKE, sample: int = BINS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``mark, label``: the class of every text (by its MD5) that is linked to another one.

    Links are all pairs of distinct texts whose lower-cased shingles have Jaccard similarity ``least``
    or more. Null and wordless texts have none. Shingles are counted in ``sample`` bins, a power of two; 0 counts none.
    """
    texts = numbered(docs, text_col)
    shared = cut_lineage(buckets(prefixes(texts, shingle, least, max(1, sample))))
    drawn = cut_lineage(sketches(texts, shingle))
    num, den = least.numerator, least.denominator

    def can(a_size: str, a_pos: str, b_size: str, b_pos: str):
        """Sizes fit, and what may follow the shared shingle is enough; true at the first shared one of every pair sought."""
        fits = f"least({a_size}, {b_size}) * {den} >= greatest({a_size}, {b_size}) * {num}"
        return F.expr(f"{fits} and least({a_size} - {a_pos}, {b_size} - {b_pos}) * {num + den} >= {num} * ({a_size} + {b_size})")

    def verified(pairs: DataFrame) -> DataFrame:
        """``a, b, a_key, b_key``: marks and numbers of the pairs ``a, b`` of numbers that are alike."""
        met = pairs.distinct().join(drawn.selectExpr("key as a", "size as a_size", "bits as a_bits"), "a")
        met = met.join(drawn.selectExpr("key as b", "size as b_size", "bits as b_bits"), "b")
        pairs = cut_lineage(met.filter(possible(least)("a_size", "a_bits", "b_size", "b_bits")).select("a", "b").distinct())
        ends = pairs.selectExpr("explode(array(a, b)) as key").distinct()
        held = texts.join(ends, "key", "left_semi").select("key", F.md5("text").alias("mark"), "text")
        held = cut_lineage(held.dropDuplicates(["key", "mark"]))
        both = pairs.join(held.selectExpr("key as a", "mark as a_mark", "text as a_text"), "a")
        both = both.join(held.selectExpr("key as b", "mark as b_mark", "text as b_text"), "b")
        both = both.filter(similar(least, shingle)(F.col("a_text"), F.col("b_text")))
        found = cut_lineage(both.selectExpr("a_mark as a", "b_mark as b", "a as a_key", "b as b_key"))
        discard(pairs)
        discard(held)
        return found

    near = verified(shared.filter(can("hub_size", "hub_pos", "size", "pos")).selectExpr("hub as a", "key as b"))
    labels = connected_components(near.select("a", "b"))
    named = near.selectExpr("stack(2, a, a_key, b, b_key) as (id, key)").join(labels, "id").groupBy("key").agg(F.min("label").alias("label"))
    marked = shared.select("s", "key", "size", "pos").join(named, "key", "left").withColumn("label", F.coalesce("label", F.col("key").cast("string")))
    mixed = marked.groupBy("s").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")).filter("low <> high")
    rest = marked.join(mixed.select("s", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")), "s")
    dealt = rest.withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn("met", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = cut_lineage(dealt.select("s", "key", "size", "pos", "label", "own", F.least("own", "met").alias("lo"), F.greatest("own", "met").alias("hi")))
    discard(shared)
    left, right = dealt.alias("p"), dealt.alias("q")
    apart = F.expr("p.label <> q.label and p.own = p.lo and q.own = p.hi and (p.lo < p.hi or p.key < q.key)")
    met = left.join(right, F.expr("p.s = q.s and p.lo = q.lo and p.hi = q.hi") & apart & can("p.size", "p.pos", "q.size", "q.pos"))
    far = verified(met.selectExpr("least(p.key, q.key) as a", "greatest(p.key, q.key) as b"))
    discard(dealt)
    discard(drawn)
    return connected_components(near.select("a", "b").union(far.select("a", "b"))).select(F.col("id").alias("mark"), "label")


def one_row_each(docs: DataFrame, rows: DataFrame, mark, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without all but one row of each class: the one with the smallest id, then mark; null ids come last.

    ``rows`` has ``id, mark, label`` of each row of ``docs`` that has a class, ``mark`` is the expression of that column over
    ``docs``. Rows without a class stay. Whole rows travel once.
    """
    order = F.struct(F.col("id").isNull().alias("nameless"), "id", "mark")
    best = rows.groupBy("label").agg(F.min(order).alias("best"), F.count("*").alias("n")).filter("n > 1")
    judged = cut_lineage(rows.join(best, "label").select("id", "mark", F.expr("id <=> best.id and mark = best.mark").alias("stays")))
    gone = judged.filter("not stays").select(F.col("id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct()
    again = judged.filter("stays").groupBy("id", "mark").count().filter("count > 1").select("id", "mark")
    name = fresh("row_mark", docs)
    marked = docs.withColumn(name, mark)
    same = lambda i, m: F.col(id_col).eqNullSafe(F.col(i)) & (F.col(name) == F.col(m))
    # rows travel once whatever the number that goes, and are not sorted
    kept = marked.join(gone.hint("shuffle_hash"), same("gone_id", "gone_mark"), "left_anti")
    if again.isEmpty():
        return kept.select(docs.columns)
    again = again.select(F.col("id").alias("gone_id"), F.col("mark").alias("gone_mark"))
    single = kept.join(again, same("gone_id", "gone_mark"), "left_anti")
    one = kept.join(again, same("gone_id", "gone_mark"), "left_semi").dropDuplicates([id_col, name])
    return single.unionByName(one).select(docs.columns)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without all but one row of each class: the one with the smallest id, then MD5; null ids come last.

    Copies are a class of their own. Rows without a text stay. Columns beside the two may have any name.
    """
    mark = F.md5(F.col(text_col).cast("string"))
    classes = near_classes(docs, text_col, **options)
    rows = docs.select(F.col(id_col).alias("id"), mark.alias("mark")).filter("mark is not null").join(classes, "mark", "left")
    return one_row_each(docs, rows.withColumn("label", F.coalesce("label", "mark")), mark, id_col)
