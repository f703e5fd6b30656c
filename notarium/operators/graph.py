"""Graph operators: components, degrees, closures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep


def components(edges: DataFrame, a: str = "src", b: str = "dst", most_rounds: int = 60) -> DataFrame:
    """(node, component): the least node that each node is connected with.

    Alternating large-star and small-star steps: in each round every node's
    larger (then smaller) neighbours are linked to its least neighbour, so the
    rounds follow the logarithm of the longest path, and a hub's links become
    links of the least node instead of pairs.  The links are written to the
    shared folder in each round; the end is known from their digest.
    Self-links and repeated links are dropped; null ends are no nodes.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    nodes = both.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    links = keep(both.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    digest = None
    for _ in range(most_rounds):
        # large star: every larger neighbour to the least of node and neighbours
        either = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = either.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = either.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every smaller neighbour and the node itself to the least neighbour
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        links = keep(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == digest:
            break
        digest = now
    else:
        raise RuntimeError("components did not settle in the rounds allowed")
    found = links.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(found.withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def symmetric(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs in both directions, once each."""
    turned = pairs.select(F.col(b).alias(a), F.col(a).alias(b))
    return pairs.select(a, b).unionByName(turned).distinct()


def in_degree(links: DataFrame, src: str, dst: str) -> DataFrame:
    """(dst, degree): how many other nodes link there; self-links do not count."""
    return links.where(F.lower(F.col(src)) != F.lower(F.col(dst))).groupBy(F.lower(F.col(dst)).alias(dst)).agg(F.count_distinct(src).alias("degree"))
