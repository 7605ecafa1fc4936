"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusmap.session import cut_lineage, discard


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, label`` for every node of ``a, b`` edges; the label is the component's smallest id.

    Each round every node points at its smallest neighbour, pointers are followed to their end,
    and the edges are redrawn between the ends. At least half of the ends vanish per round, so
    long chains take few rounds. Minima combine map-side, so a node with very many edges stays
    cheap to aggregate.
    """
    one_way = edges.filter("a <> b")
    active = cut_lineage(one_way.select("a", "b").union(one_way.select("b", "a")).distinct())
    labels = active.select(F.col("a").alias("id"), F.col("a").alias("label")).limit(0)
    first = True
    while not active.isEmpty():
        ends = _follow(
            active.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low")).select(
                "id", F.least("id", "low").alias("label")
            )
        )
        if first:
            labels, first = ends, False
        else:
            onward = ends.select(F.col("id").alias("label"), F.col("label").alias("end"))
            labels = cut_lineage(
                labels.join(onward, "label", "left").select("id", F.coalesce("end", "label").alias("label"))
            )
        to_a = ends.select(F.col("id").alias("a"), F.col("label").alias("end_a"))
        to_b = ends.select(F.col("id").alias("b"), F.col("label").alias("end_b"))
        before = active
        active = cut_lineage(
            active.join(to_a, "a").join(to_b, "b").filter("end_a <> end_b")
            .select(F.col("end_a").alias("a"), F.col("end_b").alias("b")).distinct()
        )
        discard(before)
    return labels


def _follow(pointers: DataFrame) -> DataFrame:
    """Every pointer moved to the end of its path, doubling the steps each time."""
    pointers = cut_lineage(pointers)
    while True:
        onward = pointers.select(F.col("id").alias("label"), F.col("label").alias("end"))
        moved = cut_lineage(
            pointers.join(onward, "label").select("id", F.col("end").alias("label"), (F.col("end") != F.col("label")).alias("moved"))
        )
        discard(pointers)
        pointers = moved.select("id", "label")
        pointers.step_path = moved.step_path
        if moved.filter("moved").isEmpty():
            return pointers
