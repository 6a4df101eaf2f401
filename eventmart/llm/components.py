"""Connected components of an undirected graph, by alternating star contractions.

Each round reads and writes edge tables in the shared folder; no vertex, edge or component
passes through the driver, and a hub's edges are aggregated before they are shuffled. Minima
are written before they are joined back, so that the join can split a hub over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart import runtime


def _minima(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each u."""
    return runtime.written(edges.groupBy("u").agg(F.min("v").alias("m")), "component-minima")


def _step(edges: DataFrame, around: DataFrame, moved) -> DataFrame:
    """Edges after one contraction, written; ``moved(edges, minima)`` gives them."""
    minima = _minima(around)
    out = runtime.written(moved(around, minima).distinct(), "component-edges")
    runtime.released(minima, edges)
    return out


def _large(edges: DataFrame, minima: DataFrame) -> DataFrame:
    """Every larger neighbour of u moves to the smallest vertex around u."""
    near = edges.join(minima, "u").withColumn("m", F.least("m", "u"))
    moved = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u != v")


def _small(edges: DataFrame, minima: DataFrame) -> DataFrame:
    """u and its smaller neighbours move to the smallest of them; edges have u > v."""
    near = edges.join(minima, "u")
    moved = near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(near.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component_id) for every vertex of ``edges`` (a, b), written; the smallest id names
    a component.

    Loops, repeated edges and edges with a null end are ignored.
    """
    now = runtime.written(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "component-edges",
    )
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        stars = _step(now, both, _large)
        now = _step(stars, stars, _small)
    names = now.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    out = runtime.written(names.union(roots), "components")
    runtime.released(now)
    return out
