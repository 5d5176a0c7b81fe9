"""Connected components by alternating stars, for graphs and for rows that share keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.operators.skew import skewed_lookup
from tamiz.session import cut


def tidy_edges(edges: DataFrame) -> DataFrame:
    """Distinct `u < v` without nulls and loops."""
    u, v = F.col("u").cast("bigint"), F.col("v").cast("bigint")
    return edges.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v"), (u.isNotNull() & v.isNotNull() & (u != v)).alias("__ok")).where("__ok").select("u", "v").distinct()


def star_edges(rows: DataFrame, row_id: str, key: str) -> DataFrame:
    """Edges from the smallest id of every non-empty key to its other rows: one edge a row, never all pairs."""
    keyed = rows.where(F.coalesce(F.col(key) != "", F.lit(False))).select(F.col(row_id).cast("bigint").alias("v"), F.col(key).alias("__k"))
    heads = keyed.groupBy("__k").agg(F.min("v").alias("u"), F.count(F.lit(1)).alias("__w")).where("__w > 1")
    return skewed_lookup(keyed, heads, "__k", weight="__w").where("u <> v").select("u", "v")


def star_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """`id, label` of every vertex with an edge; `label` is the smallest id of its component.

    Each round hangs every vertex below the smallest vertex it can see (large star, then small star) until
    the edges are stars; rounds grow with the logarithm of the diameter. Lineage is cut in the shared checkpoint
    folder every round. Raises RuntimeError if `max_rounds` is not enough instead of giving wrong labels.
    """
    e = cut(tidy_edges(edges))
    state = lambda d: d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    seen = state(e)
    for _ in range(max_rounds):
        n = seen[0]
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        # Large star: neighbours above u hang below the smallest vertex around u.
        large = skewed_lookup(e, low, "u", rows=n).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = cut(large.unionByName(low.where("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        # Small star: of the smaller neighbours of a, the smallest takes the others.
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("w"))
        least = down.groupBy("u").agg(F.min("w").alias("m"))
        small = skewed_lookup(down, least, "u", rows=3 * n).select(F.col("w").alias("v"), F.col("m").alias("u"))
        e = cut(tidy_edges(small.unionByName(least.select(F.col("u").alias("v"), F.col("m").alias("u")))))
        now = state(e)
        if now == seen:
            leaves = e.select(F.col("v").alias("id"), F.col("u").alias("label"))
            return leaves.unionByName(e.select(F.col("u").alias("id"), F.col("u").alias("label")).distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def key_edges(rows: DataFrame, row_id: str, keys: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [star_edges(rows, row_id, k) for k in keys])
