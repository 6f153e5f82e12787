"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import _common as C


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame, a: str = "a", b: str = "b",
                         write: Callable[[DataFrame], DataFrame] = C.cut) -> DataFrame:
    """node, root: every node that has a link to another, with the smallest
    node of its component. Links and labels stay distributed; each round is
    a few joins and ends in a written table (a checkpoint, or as ``write``
    does it), and the driver only compares a count and a checksum.

    A round is a large star (each node hands its larger neighbours its
    smallest neighbour) and a small star (it hands that to its smaller ones
    and itself); the fixed point is one star per component.
    """
    edges = write(links.where(F.col(a) != F.col(b))
                  .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = write(small)
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
