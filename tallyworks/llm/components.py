"""Connected components of a graph kept as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyworks.sources.shared import settle


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b) that is not its component's smallest.

    Alternating large and small stars: every node points its larger neighbours, then its
    smaller ones, to the smallest it knows, until all edges are stars.  Every round is a
    written table; minima are added up before the shuffle, so a hub is no burden.
    """
    stars, mark = _settled(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while mark[0]:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"),
                                                                F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        before = mark
        stars, mark = _settled(small.distinct())
        if mark == before:
            break
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _settled(stars: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges written, with their number and a digest that their order does not change."""
    seen = Observation()
    kept = settle(stars.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(
        F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("digest")), "edges")
    return kept, (seen.get["n"], seen.get["digest"])
