"""Point reads, sampling, caps, unions and versioned deletes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusmap.functions import text
from corpusmap.session import cut_lineage, discard


def by_ids(df: DataFrame, ids, id_col: str = "id") -> DataFrame:
    """Rows named by a flat list of ids or by a DataFrame that has the id column."""
    return df.join(_id_frame(df, ids, id_col), id_col, "left_semi")


def without_ids(df: DataFrame, ids, id_col: str = "id") -> DataFrame:
    """Rows that stay after deleting ids."""
    return df.join(_id_frame(df, ids, id_col), id_col, "left_anti")


def _id_frame(df: DataFrame, ids, id_col: str) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select(id_col)
    if not isinstance(ids, list):
        raise TypeError("ids must be a list")
    if any(isinstance(i, (list, tuple)) for i in ids):
        raise ValueError("ids must be a flat list")
    kind = df.schema[id_col].dataType.simpleString()
    return df.sparkSession.createDataFrame([(i,) for i in ids], f"`{id_col}` {kind}")


# Hex digits that one round of a selection tells apart, and how many rows may be ranked on the driver at its end.
_DIGITS, _RANKED = 4, 1024


def smallest(df: DataFrame, n: int, order: Column) -> DataFrame:
    """Exactly ``n`` rows with the smallest ``order``, a string of evenly spread hex digits such as a digest of the id.

    Rounds count rows per next four digits, at most 65,536 numbers, and go on inside the one bin that the n-th row
    lies in; at most 1,024 orders of a last bin are looked at one by one. The result is a filter of ``df``, without a
    shuffle, so no task and not the driver receives rows that are not in the result, whatever ``n`` is. Among rows equal
    in ``order`` it may be any that fill up the number. Rows come in no order.
    """
    if n <= 0:
        return df.limit(0)
    prefix, left = "", n
    key = df.select(order.alias("k"))
    while True:
        rows = key.filter(F.col("k").startswith(prefix)) if prefix else key
        digits = F.substring("k", len(prefix) + 1, _DIGITS).alias("d")
        bins = sorted((r.d, r["count"]) for r in rows.groupBy(digits).count().collect())
        below = 0
        for digit, size in bins:
            if below + size >= left:
                break
            below += size
        else:
            return df  # fewer rows than asked for
        prefix, left = prefix + digit, left - below
        if size == left:
            return df.filter(F.substring(order, 1, len(prefix)) <= prefix)
        if size <= _RANKED or digit == "":
            break
    last = sorted(r.k for r in key.filter(F.col("k").startswith(prefix)).limit(_RANKED).collect())
    if len(last) < size:  # over 1,024 rows of one order
        return df.filter(order < prefix).unionByName(df.filter(order == prefix).limit(left))
    bound = last[left - 1]
    if left == len(last) or last[left] != bound:
        return df.filter(order <= bound)
    return df.filter(order < bound).unionByName(df.filter(order == bound).limit(left - last.index(bound)))


def hash_order(*columns: str | Column) -> Column:
    """An order for ``smallest`` over the values of some columns."""
    return F.lower(F.lpad(F.hex(F.xxhash64(*columns)), 16, "0"))


def sample(df: DataFrame, n: int, seed: int = 0, id_col: str = "id") -> DataFrame:
    """Exactly ``n`` rows, the same for the same seed."""
    order = text.seeded_order(F.col(id_col), seed)
    return smallest(df, n, order).orderBy(order, id_col)


def sample_with_replacement(df: DataFrame, fraction: float, seed: int = 0, id_col: str = "id") -> DataFrame:
    """Each row as often as a Poisson draw of mean ``fraction`` says, the same for the same id and seed.

    The draw reads a digest of the id against the distribution, so it depends on no partitioning; rows without an id get
    none.
    """
    if fraction < 0:
        raise ValueError("fraction must not be negative")
    digits = F.conv(F.substring(text.seeded_order(F.col(id_col), seed), 1, 8), 16, 10).cast("bigint")
    times = F.lit(0)
    for bound in poisson_bounds(fraction):
        times = times + (digits >= bound).cast("int")
    name = "times"
    while name in df.columns:
        name += "_"
    return df.withColumn(name, F.explode(F.array_repeat(F.lit(0), times))).drop(name)


def poisson_bounds(mean: float) -> list[int]:
    """For k = 0, 1, ..: the share of draws of at most k, in 2**32 parts, until it is all of them."""
    bounds, k, at, below = [], 0, math.exp(-mean), 0.0
    while True:
        below += at
        bound = round(below * 2**32)
        if bound >= 2**32 or (bounds and bound == bounds[-1] and k > mean):
            return bounds
        bounds.append(bound)
        k += 1
        at *= mean / k


def cap(df: DataFrame, most: int, id_col: str = "id") -> DataFrame:
    """The first ``most`` rows by id, nulls first; -1 keeps all.

    Ids alone are dealt by ranges and counted; only the range with the last id is ranked. The rows come from one filter of
    ``df`` by that id, sorted in parallel.
    """
    if most < 0:
        return df
    dealt = cut_lineage(df.select(F.col(id_col).alias("id")).repartitionByRange("id").select("id", F.spark_partition_id().alias("part")))
    before = 0
    for part, size in sorted((r.part, r["count"]) for r in dealt.groupBy("part").count().collect()):
        if before + size >= most:
            break
        before += size
    else:
        return df.orderBy(id_col)
    ranked = dealt.filter(F.col("part") == part).groupBy("id").count()
    upto = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bound = ranked.withColumn("upto", F.sum("count").over(upto)).filter(F.col("upto") >= most - before).orderBy("id").first()
    discard(dealt)
    key, extra = F.col(id_col), bound.upto - (most - before)
    if bound.id is None:
        return df.filter(key.isNull()).limit(most)
    if not extra:
        return df.filter(key.isNull() | (key <= F.lit(bound.id))).orderBy(id_col)
    first = df.filter(key.isNull() | (key < F.lit(bound.id)))
    return first.unionByName(df.filter(key == F.lit(bound.id)).limit(bound["count"] - extra)).orderBy(id_col)


def translations(df: DataFrame, keep: list[str], languages: dict[str, str]) -> DataFrame:
    """One ``language, text`` row per language from parallel text columns."""
    renamed = df.select(*keep, *[F.col(c).alias(lang) for lang, c in languages.items()])
    return renamed.unpivot(keep, list(languages), "language", "text")


def derived(df: DataFrame, name: str, separator: str, parts: list[str | Column]) -> DataFrame:
    """A column that joins others."""
    return df.withColumn(name, F.concat_ws(separator, *parts))


def union(tables: list[DataFrame]) -> DataFrame:
    """All rows of tables of one schema."""
    merged = tables[0]
    for t in tables[1:]:
        merged = merged.unionByName(t)
    return merged


def new_rows(incoming: DataFrame, existing: DataFrame, id_col: str = "id") -> DataFrame:
    """Incoming rows whose id is not stored yet, one per id."""
    return incoming.dropDuplicates([id_col]).join(existing.select(id_col), id_col, "left_anti")


def category_timeline(df: DataFrame, time_col: str, category: str, width: str) -> DataFrame:
    """Rows per time bucket and category: ``bucket, category, n``."""
    bucket = F.window(F.col(time_col), width)
    return (
        df.groupBy(bucket.alias("w"), F.col(category).alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("bucket"), "category", "n")
    )


def precision_recall(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """One row: ``tp, fp, fn, tn, precision, recall`` of two boolean columns."""
    p, a = F.col(predicted), F.col(actual)
    counts = df.agg(
        F.count_if(p & a).alias("tp"),
        F.count_if(p & ~a).alias("fp"),
        F.count_if(~p & a).alias("fn"),
        F.count_if(~p & ~a).alias("tn"),
    )

    def share(part: str, other: str) -> Column:
        size = F.col(part) + F.col(other)
        return F.when(size > 0, F.col(part) / size)

    return counts.withColumns({"precision": share("tp", "fp"), "recall": share("tp", "fn")})
