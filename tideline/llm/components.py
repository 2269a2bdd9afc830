"""Connected components of an edge table, as DataFrame rounds over a reliable checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import saved


def _minima(edges: DataFrame, keep: str) -> DataFrame:
    """Per node the smallest of itself and its (kept) neighbours; combined per task, so a star's centre is no hot key."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    if keep == "all":
        return least.withColumn("m", F.least("u", "m"))
    return least


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """node, root: the smallest node that is reachable, for each node that has an edge to another one.

    Alternates large-star and small-star steps: each node links its larger neighbours, then its smaller ones, to the
    smallest it knows. The edges shrink to one star per component in a number of rounds that grows with the logarithm of
    the size. Edges stay distributed; only their count and a checksum come to the driver.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    state = saved(pairs)
    before = None
    for _ in range(max_rounds):
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_minima(both, "all"), "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        least = _minima(large, "smaller")
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.withColumnRenamed("m", "v")).filter("u <> v").distinct())
        state = saved(small)
        mark = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
