"""Connected components of an edge table by alternating large and small stars.

Every round keeps the components and brings each node nearer to the smallest node of its component;
at the end every node hangs on that smallest node. Rounds grow with the logarithm of the longest
chain. Each round is written to the checkpoint folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import cut


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a > b). The least neighbour of each node is linked to its larger (or smaller) ones."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else edges
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    linked = near.join(least, "a")
    if large:
        out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        own = least.select("a", F.col("least").alias("b"))
        out = linked.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own)
    return out.where(F.col("a") > F.col("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of ``edges`` (two bigint columns ``a``, ``b``, any order, repeats allowed)."""
    stars = cut(
        edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = _mark(stars)
    while mark[0]:
        stars = cut(_stars(_stars(stars, large=True), large=False))
        last, mark = mark, _mark(stars)
        if mark == last:
            break
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
