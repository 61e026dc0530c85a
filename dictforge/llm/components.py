"""Connected components of a graph of any size, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dictforge.session import stage


def _signature(edges: DataFrame) -> tuple:
    found = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return found["n"], found["x"]


def _stars(edges: DataFrame) -> DataFrame:
    """One round: every node hands its larger neighbours, then its smaller ones, to its smallest.

    Minima combine before their shuffle. The joins have one row per node on one side, so a node with
    very many links is split by adaptive execution on the other.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (
        both.where(F.col("v") > F.col("u")).join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    handed = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of the edges ``a``-``b``; root is the smallest node reachable.

    Each round is written to the shared folder, so lineage stays short and a lost executor costs one
    round. Self links, repeated links and links with a null end change nothing; no links give no rows.
    """
    whole = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    ends = whole.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = stage(ends.where("u <> v").distinct(), "links")
    before, now = None, _signature(current)
    while now != before and now[0]:
        current = stage(_stars(current), "stars")
        before, now = now, _signature(current)
    roots = current.select("v").distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
