"""Connected components of a link table too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import stored
from retailflow.session import dropped


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())


def components(links: DataFrame) -> DataFrame:
    """[node, root] for every node of ``links`` [a, b]; the root is the smallest node reachable.

    Alternating large and small stars: every round replaces links by links to the least neighbour,
    and ends when a round changes nothing. A round moves each link a constant number of times; the
    number of rounds grows with the logarithm of the longest path. Self links and repeated links are
    allowed; an empty table gives an empty result.
    """
    a, b = F.col("a"), F.col("b")
    edges = stored(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    before = _fingerprint(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        # Both sides of the joins come from files, so Spark can split a vertex with very many links.
        near = stored(near, "least")
        large = both.where("v > u").join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large")
        dropped(edges, near)
        near = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (
            large.join(near, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
        )
        edges = stored(small, "edges")
        dropped(large, near)
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
