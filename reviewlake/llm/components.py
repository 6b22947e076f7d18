"""Connected components of an edge table by alternating stars; nothing but a convergence mark reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import forget_shuffles
from reviewlake.session import pin


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` (the smallest node of its component) for every node of `edges` (long columns a, b).

    Each round links a node's larger neighbours, then its smaller ones, to the smallest of them; neighbour minima
    combine map-side and the join back can be split where a node has very many neighbours. Rounds are written to the
    shared folder, so a lost executor repeats at most one of them. Loops and repeated edges are allowed; an empty
    frame gives an empty result.
    """
    spark = edges.sparkSession
    a, b = F.col("a"), F.col("b")
    current = pin(_directed(edges.select("a", "b")))
    mark = _mark(current)
    while True:
        both = current.unionByName(current.select(b.alias("a"), a.alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = _directed(both.join(low, "a").filter(b > a).select(b.alias("a"), F.col("low").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        small = joined.select("a", F.col("low").alias("b")).unionByName(
            joined.filter(b != F.col("low")).select(b.alias("a"), F.col("low").alias("b"))
        )
        current = pin(_directed(small))
        seen, mark = mark, _mark(current)
        forget_shuffles(spark)
        if mark == seen:
            break
    roots = current.select(a.alias("node"), b.alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()


def _directed(edges: DataFrame) -> DataFrame:
    """Larger node first, no loops, no repeats."""
    turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return turned.filter(F.col("a") != F.col("b")).distinct()


def _mark(edges: DataFrame) -> tuple[int, int]:
    hashed = F.sum((F.xxhash64("a", "b") % (1 << 31)).cast("decimal(38,0)"))
    n, total = edges.agg(F.count("*"), hashed).first()
    return n, int(total or 0)
