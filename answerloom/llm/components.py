"""Connected components of a graph given as edges, by alternating stars.

A node's neighbours are never gathered: their least is found by salted aggregation, and the
edges are rewritten to it. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import with_group


def _least(edges: DataFrame) -> DataFrame:
    """Edges with ``low``, the least neighbour of ``u``."""
    return with_group(edges, ["u"], F.xxhash64("v"), {"low": F.min("v")}, {"low": F.min("low")})


def components(edges: DataFrame) -> DataFrame:
    """node and root (the component's least node) of every node of the edges (u, v, no nulls)."""
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(edges.distinct(), "edges")
    state = None
    while True:
        new = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if new == state:
            break
        state = new
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "low").alias("v")).distinct()
        small = _least(large)
        small = small.select("u", F.col("low").alias("v")).unionByName(
            small.select(F.col("v").alias("u"), F.col("low").alias("v"))
        )
        edges = stored(small.filter("u <> v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
