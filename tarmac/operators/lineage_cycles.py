"""Graphs with cycles: strongly connected groups, where they begin, and the way from there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.session import discard, stored


def _proper(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct()


def _trimmed(links: DataFrame) -> DataFrame:
    """The links between nodes that have a way in and a way out: no others can lie on a cycle. One round per step of the
    longest way to or from a cycle."""
    n = links.count()
    while n:
        kept = links.join(links.select(F.col("dst").alias("src")).distinct(), "src", "left_semi")
        kept = stored(kept.join(links.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst"), "links")
        discard(links)
        before, n, links = n, kept.count(), kept
        if n == before:
            break
    return links


def _spread_least(links: DataFrame, start: DataFrame) -> DataFrame:
    """(node, mark): the least mark that reaches each node over the links, its own included."""
    marks, changed = start, start
    while not changed.isEmpty():
        sent = changed.join(links, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("node")).agg(F.min("mark").alias("sent"))
        following = marks.join(sent, "node", "left").select("node", F.least("mark", "sent").alias("mark"), (F.col("sent") < F.col("mark")).alias("is_new"))
        following = stored(following, "marks")
        marks, changed = following.select("node", "mark"), following.filter("is_new").select("node", "mark")
    return marks


def cycle_groups(edges: DataFrame) -> DataFrame:
    """(node, cycle): all nodes that lie on a cycle of other nodes, with the least node of their strongly connected group.

    Nodes off all cycles are cut off first. Then every node gets the least node that reaches it; what
    reaches that one in turn among the nodes of the same mark is its group, which is taken out, and so on with
    the rest. Rounds grow with the length of the ways and the number of groups behind each other, and each is
    stored in the shared folder; rows are nodes and links. Loops of one node do not count here.
    """
    links, found = _trimmed(stored(_proper(edges), "links")), []
    while not links.isEmpty():
        nodes = links.select(F.col("src").alias("node")).distinct()
        marked = _spread_least(links, stored(nodes.select("node", F.col("node").alias("mark")), "marks"))
        of_src, of_dst = marked.toDF("src", "src_mark"), marked.toDF("dst", "dst_mark")
        inner = links.join(of_src, "src").join(of_dst, "dst").filter("src_mark = dst_mark")
        inner = stored(inner.select("src", "dst", F.col("src_mark").alias("cycle")), "inner")
        # against the links, from the node that gave its name to the mark
        group = stored(inner.select(F.col("cycle").alias("node"), "cycle").distinct(), "group")
        fresh = group
        while not fresh.isEmpty():
            back = fresh.join(inner, (fresh.node == inner.dst) & (fresh.cycle == inner.cycle)).select(F.col("src").alias("node"), fresh.cycle.alias("cycle"))
            fresh = stored(back.distinct().join(group, ["node", "cycle"], "left_anti"), "group")
            group = group.unionByName(fresh)
        found.append(group)
        gone = group.select("node")
        rest = links.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(gone.withColumnRenamed("node", "dst"), "dst", "left_anti")
        links = _trimmed(stored(rest.select("src", "dst"), "links"))
    if not found:
        return edges.select(F.col("src").alias("node"), F.col("src").alias("cycle")).limit(0)
    return reduce(DataFrame.unionByName, found)


def origins(edges: DataFrame) -> DataFrame:
    """(node, origin, hops, in_cycle): for every node of the graph the nearest place where data comes from.

    Data comes from nodes, or groups of nodes on common cycles, that nothing outside leads into; the least node of such a
    group is its origin, and all of the group have 0 hops. Of origins equally near, the least counts. ``in_cycle`` marks
    nodes that reach themselves, also directly.
    """
    links = stored(_proper(edges), "links")
    loops = edges.filter("src = dst").select(F.col("src").alias("node"), F.lit(True).alias("is_loop")).distinct()
    ends = F.array(F.struct(F.col("src").alias("node")), F.struct(F.col("dst").alias("node")))
    nodes = edges.select(F.inline(ends)).filter("node IS NOT NULL").distinct()
    groups = stored(cycle_groups(links), "groups")
    placed = nodes.join(groups, "node", "left").join(loops, "node", "left")
    in_cycle = (F.col("cycle").isNotNull() | F.col("is_loop").isNotNull()).alias("in_cycle")
    placed = stored(placed.select("node", F.coalesce("cycle", "node").alias("group"), in_cycle), "placed")

    of_src, of_dst = (placed.select(F.col("node").alias(side), F.col("group").alias(f"{side}_group")) for side in ("src", "dst"))
    entered = links.join(of_src, "src").join(of_dst, "dst").filter("src_group <> dst_group").select(F.col("dst_group").alias("group")).distinct()
    first = placed.join(entered, "group", "left_anti").select("node", F.col("group").alias("origin"), F.lit(0).alias("hops"))
    reached = fresh = stored(first, "reached")
    while not fresh.isEmpty():
        step = fresh.join(links, F.col("node") == F.col("src"))
        nearest = step.groupBy(F.col("dst").alias("node")).agg(F.min("origin").alias("origin"), (F.min("hops") + 1).alias("hops"))
        fresh = stored(nearest.join(reached.select("node"), "node", "left_anti"), "reached")
        reached = reached.unionByName(fresh)
    return reached.join(placed.select("node", "in_cycle"), "node")
