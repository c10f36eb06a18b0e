"""Connected components by alternating stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Scratch


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour, itself included."""
    near = _both(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them. Edges go from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
    return edges.join(least, "u").select(linked.alias("e")).select("e.u", "e.v").filter("u > v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either linked to one smaller node only, or has larger neighbours only."""
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("to")).union(edges.select("v", F.lit(None).cast("long")))
    nodes = ends.groupBy("node").agg(F.min("to").alias("low"), F.max("to").alias("high"), F.max(F.col("to").isNull()).alias("centre"))
    return nodes.filter("low <> high OR (centre AND low IS NOT NULL)").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, scratch: Scratch, label: str = "stars") -> DataFrame:
    """(node, component) of every node on a link; the component is its smallest node.

    ``links`` has columns ``a`` and ``b``. Alternating stars need a logarithmic number of rounds in practice; each round's
    edges are written to shared storage, and the rounds end when they are stars, which may be at the start. A node with very many links is only ever the unique side of a join.
    """
    edges = scratch.keep(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                         f"{label}-0")
    turn = 0
    while not _are_stars(edges):
        turn += 1
        after = scratch.keep(_small_star(_large_star(edges)), f"{label}-{turn}")
        scratch.drop(f"{label}-{turn - 1}")
        edges = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
