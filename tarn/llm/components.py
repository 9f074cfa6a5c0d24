"""Connected components of a link table, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, label) of every id in ``links`` (a, b); ids of a component share a label, one of them.

    Each round maps an id to the least id among itself and its neighbours and contracts the links; ids
    are hashes, so about half of them go in a round, whatever the component's shape.  The rounds' maps
    are then composed.  An empty table has no ids.
    """
    edges = scratch.save(links.select("a", "b").where("a <> b").distinct(), f"{name}-0")
    maps = []
    while not edges.isEmpty():
        k = len(maps) + 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = scratch.save(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}-map{k}")
        left, right = step.toDF("a", "x"), step.toDF("b", "y")
        closer = edges.join(left, "a").join(right, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = scratch.save(closer, f"{name}-{k}")
        maps.append(step)
    if not maps:
        return edges.toDF("id", "label")
    whole = maps[-1]
    for step in reversed(maps[:-1]):
        later = whole.toDF("label", "_label")
        whole = step.join(later, "label", "left").select("id", F.coalesce("_label", "label").alias("label"))
    out = scratch.save(whole, f"{name}-labels")
    scratch.drop(f"{name}-0", *(f"{name}-{x}{k + 1}" for k in range(len(maps)) for x in ("", "map")))
    return out
