"""Connected components of a link table, by alternating large-star and small-star steps over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.common import saved


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the least neighbour of each u, written, so that the join shuffles for itself and can split the edges of a hub at run time."""
    return saved(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges(u, v) of any comparable type to (u, v): every node that is not the least of its component, and that least
    node. Every step is an aggregation and a join on one column, whose result is written, so a lost executor costs one
    step; the number of steps grows with the logarithm of the component's size. Self links, repeats and nulls add nothing."""
    edges = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = saved(_small_star(saved(_large_star(edges), "large")), "star")
        was, state = state, _state(edges)
        if was == state:
            break
    return edges
