"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tarmac.session import discard, stored

#: Rows of two numbers that one file holds at most, where a table is dealt into fewer files than a shuffle has partitions.
ROWS_A_FILE = 500_000


def in_few_files(df: DataFrame, most_rows: int) -> DataFrame:
    """A table of narrow rows, ``most_rows`` at most, in no more partitions than it needs: one a core, or one for each ``ROWS_A_FILE``.

    A small table that keeps a shuffle's partitions is written as hundreds of files of a few rows. The joins and sums
    before run in all partitions as they did. A table that needs as many files as a shuffle makes is left as it is.
    """
    spark = df.sparkSession
    files = max(spark.sparkContext.defaultParallelism, -(-most_rows // ROWS_A_FILE))
    return df.repartition(files) if files < int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def connected_components(edges: DataFrame, most_edges: int | None = None) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Alternates two steps until nothing changes: every node sends its larger neighbours to the smallest it
    knows, then its smaller ones. Each step is a minimum per node, combined before the shuffle, and a join;
    no neighbour list is ever collected, so a hub with a third of all edges is only a skewed join. Rounds grow with
    the logarithm of the longest chain. Each round is written to the shared folder, and counted while it is written; as no
    round has more rows than the one before, small ones are written as few files. ``most_edges``, where the caller knows it, is a number
    that the edges do not exceed, so that the first table is written so too. Rows with a
    NULL end and loops are left out, repeated edges count once; without edges the result is empty.
    """
    a, b = F.col("a"), F.col("b")
    start = edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current, state = _stored_and_counted(start, most_edges)
    while True:
        both = current.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # an edge becomes one edge at most, so repeated ones need not be removed here
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following, after = _stored_and_counted(moved.unionByName(least.withColumnRenamed("m", "v")), state[0])
        discard(current)
        current, before, state = following, state, after
        if state == before:
            break
    # nothing changed: one edge from every node to its root
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    # an edge has one root at most
    return in_few_files(current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), 2 * state[0])


def _stored_and_counted(edges: DataFrame, most_rows: int | None) -> tuple[DataFrame, tuple]:
    """The edges, written, with their number and a sum of their digests: equal for equal tables."""
    seen = Observation()
    digest = F.xxhash64("u", "v").cast("decimal(20,0)")
    counted = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(digest).alias("digest"))
    kept = stored(counted if most_rows is None else in_few_files(counted, most_rows), "edges")
    return kept, tuple(seen.get.values())
