"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_folder, written


def connected_components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``): its component's smallest node.

    Each round hangs every node's neighbours on the smallest of them, so that long chains shrink
    by a constant factor; the rounds end when every component is a star around its root. Minima
    are aggregated before they meet the edges again, and a node with very many neighbours is a
    skewed join key, which adaptive execution splits. Rounds are cut by tables in the shared
    folder, so a lost executor never repeats more than one.
    """
    folder = folder or shared_folder(edges.sparkSession)
    edges = edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).filter("a <> b")
    edges, before = written(edges.distinct(), folder), None
    while (state := _digest(edges)) != before:
        before = state
        edges = written(_small_star(_large_star(edges)), folder)
    roots = edges.select("b").distinct()
    return edges.selectExpr("a AS node", "b AS root").unionByName(
        roots.selectExpr("b AS node", "b AS root")
    )


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours on the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return both.filter("b > a").join(least, "a").selectExpr("b AS a", "least AS b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    hung = edges.join(least, "a").filter("b <> least").selectExpr("b AS a", "least AS b")
    return hung.unionByName(least.selectExpr("a", "least AS b")).distinct()
