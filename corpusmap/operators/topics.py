"""Topic tables: model, labels, hierarchy, grouping and density."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from corpusmap.functions import blocks, text, times, vectors
from corpusmap.session import cut_lineage, spread

# Keywords per topic, the default depths' sizes, and how to cluster.
KEYWORDS = 15
TOPIC_SIZES = (8, 32, 128)
CLUSTER_METHODS = ("fast",)
# Words in a larger share of the texts than this say nothing about a topic.
COMMON_SHARE = 0.5


def depth_columns(df: DataFrame) -> list[str]:
    """``topic_depth_1..n`` in order."""
    found = [c for c in df.columns if c.startswith("topic_depth_")]
    return sorted(found, key=lambda c: int(c.rsplit("_", 1)[1]))


def _check_depth(df: DataFrame, depth: int) -> str:
    columns = depth_columns(df)
    if not 1 <= depth <= len(columns):
        raise ValueError(f"topic depth must be between 1 and {len(columns)}")
    return columns[depth - 1]


def metadata(raw: DataFrame) -> DataFrame:
    """Stored topic rows under their public names."""
    names = {c: c[1:] for c in raw.columns if c.startswith("_topic_depth_")}
    return raw.withColumnsRenamed({"topic": "topic_id", **names})


def label_topics(coded: DataFrame, meta: DataFrame) -> DataFrame:
    """Per-row topic ids of each depth replaced by labels; an unknown id becomes null.

    One pass: the rows stay where they are, and the small label table is joined per depth.
    """
    out = coded
    for depth, column in enumerate(depth_columns(coded), start=1):
        labels = meta.filter(F.col("depth") == depth).select(
            F.col("topic_id").alias(column), F.col("topic_short_description").alias("_label")
        )
        out = out.join(labels, column, "left").drop(column).withColumnRenamed("_label", column)
    return out.select(*coded.columns)


def hierarchy(meta: DataFrame) -> DataFrame:
    """Edges ``topic, depth, subtopic`` between adjacent labels of the topic paths."""
    columns = depth_columns(meta)
    pairs = [
        F.struct(F.col(a).alias("topic"), F.lit(d).alias("depth"), F.col(b).alias("subtopic"))
        for d, (a, b) in enumerate(zip(columns, columns[1:]), start=1)
    ]
    edges = meta.select(F.inline(F.array(*pairs)))
    return edges.filter("topic IS NOT NULL AND subtopic IS NOT NULL").distinct()


def topic_members(rows: DataFrame, depth: int = 1) -> DataFrame:
    """Row ids of each topic at a depth, one ``topic, id`` per line and no group ever collected."""
    column = _check_depth(rows, depth)
    return rows.filter(F.col(column).isNotNull()).select(F.col(column).alias("topic"), "id").distinct()


def group_by_topic(rows: DataFrame, meta: DataFrame, depth: int = 1) -> DataFrame:
    """Each non-empty topic of a depth with its descriptions, subtopics and number of rows.

    The rows themselves come from ``topic_members``: a topic may hold more ids than a row can.
    """
    column = _check_depth(rows, depth)
    sizes = (
        rows.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("topic_short_description"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    topics = meta.filter(F.col("depth") == depth).select(
        "topic_id", "topic_short_description", F.col("topic_description").alias("topic_long_description")
    )
    children = hierarchy(meta).filter(F.col("depth") == depth)
    child_ids = meta.filter(F.col("depth") == depth + 1).select(
        F.col("topic_short_description").alias("subtopic"), F.col("topic_id").alias("subtopic_id")
    )
    subtopics = (
        children.join(child_ids, "subtopic", "left")
        .groupBy(F.col("topic").alias("topic_short_description"))
        .agg(F.array_sort(F.collect_list(F.struct("subtopic", "subtopic_id"))).alias("s"))
        .select(
            "topic_short_description",
            F.col("s.subtopic").alias("subtopics"),
            F.col("s.subtopic_id").alias("subtopic_ids"),
        )
    )
    return sizes.join(topics, "topic_short_description").join(subtopics, "topic_short_description", "left")


def _by_depth(rows: DataFrame) -> DataFrame:
    columns = depth_columns(rows)
    pairs = [F.struct(F.lit(d).alias("depth"), F.col(c).alias("topic")) for d, c in enumerate(columns, start=1)]
    return rows.withColumn("_pair", F.explode(F.array(*pairs))).withColumns(
        {"depth": F.col("_pair.depth"), "topic": F.col("_pair.topic")}
    )


def topic_density(rows: DataFrame, time_col: str, start, end, collapse: bool = False) -> DataFrame:
    """Rows per topic within a time range, largest first; a null topic is counted too.

    ``collapse`` sums over depths by label.
    """
    inside = rows.filter(times.between(F.col(time_col), start, end))
    key = ["topic"] if collapse else ["depth", "topic"]
    return (
        _by_depth(inside.select(*depth_columns(rows)))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), *key)
    )


def topic_trend(rows: DataFrame, time_col: str, earlier: tuple, later: tuple) -> DataFrame:
    """Rows per topic in two time ranges and the change, from one pass."""
    first, second = (times.between(F.col(time_col), *w) for w in (earlier, later))
    counted = _by_depth(rows.filter(first | second)).groupBy("depth", "topic").agg(
        F.count_if(first).alias("n_earlier"), F.count_if(second).alias("n_later")
    )
    return counted.withColumn("change", F.col("n_later") - F.col("n_earlier"))


def in_topic(rows: DataFrame, label: str, depth: int = 1) -> DataFrame:
    return rows.filter(F.col(_check_depth(rows, depth)) == label)


def topic_keywords(
    rows: DataFrame,
    topic_cols: str | Sequence[str],
    text_col: str,
    n: int = KEYWORDS,
    common_share: float = COMMON_SHARE,
) -> DataFrame:
    """The words that set each topic apart: ``depth, topic, rank, word, score``.

    Class-based TF-IDF over the number of texts with a word. Words of most texts are left out.
    The texts are read once: words are counted by the whole topic path, and each depth adds up
    those counts.
    """
    columns = [topic_cols] if isinstance(topic_cols, str) else list(topic_cols)
    rows = spread(rows.select(*columns, text_col))
    words = rows.select(*columns, F.explode(F.array_distinct(text.tokens(F.col(text_col)))).alias("word"))
    by_path = cut_lineage(words.groupBy(*columns, "word").agg(F.count(F.lit(1)).alias("n")))
    texts = rows.count()
    totals = by_path.groupBy("word").agg(F.sum("n").alias("total")).filter(F.col("total") <= common_share * texts)
    ranked = []
    for depth, column in enumerate(columns, start=1):
        counts = by_path.groupBy(F.col(column).alias("topic"), "word").agg(F.sum("n").alias("n"))
        whole = by_path.agg(F.sum("n").alias("n"), F.count_distinct(column).alias("topics")).first()
        mean = (whole["n"] or 0) / max(1, whole["topics"])
        score = F.round(F.col("n") * F.log(1 + F.lit(mean) / F.col("total")), 9)
        scored = counts.join(totals, "word").select(F.lit(depth).alias("depth"), "topic", "word", score.alias("score"))
        best = Window.partitionBy("topic").orderBy(F.desc("score"), "word")
        ranked.append(scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n))
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionByName(more)
    return out


def describe_topics(keywords: DataFrame) -> DataFrame:
    """``topic, topic_short_description, topic_description``; short labels are unique per depth.

    One line per topic: the short label is the shortest unique run of its best words.
    """
    words = keywords.groupBy("depth", "topic").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda s: s["word"]).alias("words")
    )
    named = words.withColumn("topic_description", F.array_join("words", "/"))
    for length in (1, 2, 3):
        prefix = F.array_join(F.slice("words", 1, length), " / ")
        unique = F.count(F.lit(1)).over(Window.partitionBy("depth", prefix)) == 1
        named = named.withColumn(f"_l{length}", F.when(unique, prefix))
    fallback = F.concat_ws(" ", F.array_join(F.slice("words", 1, 3), " / "), F.col("topic").cast("string"))
    return named.select(
        "topic",
        F.coalesce("_l1", "_l2", "_l3", fallback).alias("topic_short_description"),
        "topic_description",
    )


def fit_topics(
    points: DataFrame,
    sizes: Sequence[int] = TOPIC_SIZES,
    *,
    enforce_hierarchy: bool = False,
    cluster_method: str = "fast",
    seed: int = 1,
) -> DataFrame:
    """``id, topic_depth_1..n`` as topic numbers, which differ between depths.

    Without an enforced hierarchy every depth is clustered on its own. With it, only the finest
    depth is, and the bounded set of its centres is grouped upwards, so topics nest strictly.
    """
    if cluster_method not in CLUSTER_METHODS:
        raise ValueError(f"cluster_method must be one of {CLUSTER_METHODS}")
    if not sizes or list(sizes) != sorted(sizes):
        raise ValueError("topic sizes must grow with depth")
    unit = spread(points.select("id", "vector"))
    unit = unit.select("id", array_to_vector(vectors.normalize(F.col("vector"))).alias("features")).persist()
    try:
        n = unit.count()
        sizes = [max(1, min(s, n)) for s in sizes]
        starts = np.cumsum([0, *sizes[:-1]])
        if enforce_hierarchy:
            out, upward = _nested(unit, sizes, seed)
            for d in range(len(sizes)):
                column = F.element_at(F.array(*[F.lit(int(c + starts[d])) for c in upward[d]]), F.col("fine") + 1)
                out = out.withColumn(f"topic_depth_{d + 1}", column)
            out = out.drop("fine", "features")
        else:
            out = unit
            for d, size in enumerate(sizes):
                model = KMeans(k=size, seed=seed, maxIter=10, predictionCol="_c").fit(unit)
                out = model.transform(out).withColumn(f"topic_depth_{d + 1}", F.col("_c") + int(starts[d])).drop("_c")
            out = out.drop("features")
        return out
    finally:
        unit.unpersist()


def _nested(unit: DataFrame, sizes: list[int], seed: int):
    model = KMeans(k=sizes[-1], seed=seed, maxIter=10, predictionCol="fine").fit(unit)
    centres = np.array(model.clusterCenters())
    groups = [np.arange(len(centres))]
    for size in reversed(sizes[:-1]):
        groups.insert(0, _group_centres(centres, groups[0], size))
    return model.transform(unit), groups


def _group_centres(centres: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """Merge the two nearest groups of centres until ``size`` are left."""
    group = group.copy()
    while len(np.unique(group)) > size:
        names = np.unique(group)
        means = np.array([centres[group == g].mean(0) for g in names])
        d = blocks.rough_distances(means, means, "l2")
        np.fill_diagonal(d, np.inf)
        a, b = np.unravel_index(d.argmin(), d.shape)
        group[group == names[max(a, b)]] = names[min(a, b)]
    return np.unique(group, return_inverse=True)[1]


def topic_paths(assigned: DataFrame) -> DataFrame:
    """``topic_id, depth, path``: each topic with its most frequent ancestors, as an array of ids."""
    columns = depth_columns(assigned)
    levels = []
    for d in range(1, len(columns) + 1):
        prefix = F.array(*[F.col(c) for c in columns[:d]])
        counts = assigned.groupBy(F.col(columns[d - 1]).alias("topic_id"), prefix.alias("path")).agg(
            F.count(F.lit(1)).alias("n")
        )
        levels.append(
            counts.groupBy("topic_id").agg(
                F.lit(d).alias("depth"), F.min_by("path", F.struct(-F.col("n"), "path")).alias("path")
            )
        )
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def build_topics(
    points: DataFrame, texts: DataFrame | None, sizes: Sequence[int] = TOPIC_SIZES, **options
) -> tuple[DataFrame, DataFrame]:
    """(coded assignments, stored topic metadata). Without texts the topics stay unlabelled."""
    assigned = cut_lineage(fit_topics(points, sizes, **options))
    columns = depth_columns(assigned)
    paths = topic_paths(assigned)
    if texts is None:
        number = F.col("topic_id").cast("string")
        labels = paths.select("topic_id", number.alias("topic_short_description"), number.alias("topic_description"))
    else:
        labelled = assigned.join(texts.select("id", "text"), "id")
        labels = describe_topics(topic_keywords(labelled, columns, "text")).withColumnRenamed("topic", "topic_id")
    named = paths.join(labels, "topic_id", "left").withColumn(
        "topic_short_description", F.coalesce("topic_short_description", F.col("topic_id").cast("string"))
    )
    # One line per topic from here on.
    named = cut_lineage(named)
    meta = named
    for d in range(1, len(columns) + 1):
        ancestor = named.select(
            F.col("topic_id").alias("_a"), F.col("topic_short_description").alias(f"_topic_depth_{d}")
        )
        meta = meta.join(ancestor, F.get("path", F.lit(d - 1)) == F.col("_a"), "left").drop("_a")
    return assigned, meta.drop("path").withColumnRenamed("topic_id", "topic")
