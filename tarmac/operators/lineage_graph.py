"""Everything upstream or downstream of given datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.session import stored

HOPS_PER_ROUND = 4


def reachable(edges: DataFrame, seeds: DataFrame, *, upstream: bool = True) -> DataFrame:
    """Nodes reachable from any seed, with the fewest hops to one; the seeds themselves have 0.

    ``edges`` holds (src, dst), ``seeds`` holds (node). The result has one row per node, so it stays
    linear in the graph. Each round follows a few hops, keeps nodes not seen before and stores them in
    the shared folder. Cycles end by themselves.
    """
    here, there = ("dst", "src") if upstream else ("src", "dst")
    links = edges.select(F.col(here).alias("node"), F.col(there).alias("next")).filter("node <> next").distinct()
    links = stored(links, "links")
    seen = stored(seeds.select("node", F.lit(0).alias("hops")).distinct(), "seeds")
    edge_of_search, depth = seen, 0
    while not edge_of_search.isEmpty():
        found, step = [], edge_of_search
        for _ in range(HOPS_PER_ROUND):
            step = step.join(links, "node").groupBy(F.col("next").alias("node")).agg((F.min("hops") + 1).alias("hops"))
            found.append(step)
        nearest = reduce(DataFrame.unionByName, found).groupBy("node").agg(F.min("hops").alias("hops"))
        fresh = stored(nearest.join(seen.select("node"), "node", "left_anti"), "reached")
        seen = seen.unionByName(fresh)
        depth += HOPS_PER_ROUND
        # nearer new nodes were already followed in this round
        edge_of_search = fresh.filter(F.col("hops") == depth)
    return seen


def end_points(edges: DataFrame, *, upstream: bool = True) -> DataFrame:
    """Nodes where data ends (nobody else reads them), or where it begins for ``upstream=False``."""
    used, other = ("src", "dst") if upstream else ("dst", "src")
    proper = edges.filter("src <> dst")
    inner = F.max(F.col("role") == used)
    ends = proper.select(F.inline(F.array(*[F.struct(F.col(c).alias("node"), F.lit(c).alias("role")) for c in (used, other)])))
    return ends.groupBy("node").agg(inner.alias("is_used")).filter(~F.col("is_used")).select("node")
