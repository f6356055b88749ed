"""The trie of conversations by their turns, from common prefixes of sorted neighbours.

A conversation is the row of its turns' 128-bit digests. Sorted by these rows, conversations that share their first
turns are neighbours, and the common prefixes of neighbours hold the whole trie. Each partition of the sorted rows takes
its neighbour edges in descending depth of the common prefix and unites what they join (union-find): every union makes,
or widens, a branching node at that depth, and closes the unbranched chains of nodes below it. The counts of a node are sums over its
conversations and the edges between them, so a union adds them up.

What a partition cannot know alone lies on two paths, that of its first and that of its last conversation. Its forest is contracted to
these: their nodes leave as partial sums, named by a digest of the prefix, and are added up over partitions, with a correction
for each edge between the last row of a partition and the first of the next. All other nodes are final. So copies of a
conversation and shared openings, however many, are split over partitions, and what meets at one node is a few rows per partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.frames import broadcast_if_small
from tarmac.session import discard, stored

WORD = r"[^\x20\x09-\x0D]+"
DIGEST_BYTES = 16
#: Ids in one piece of a digest's text, where a group of equal conversations goes over the end of a partition.
IDS_AT_ONCE = 4096
NO_IDS = hashlib.sha256(b"").hexdigest()

FOREST = (
    "kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "shared long, before long, ends string, node binary, parent binary, part long, seq long, sums array<long>"
)
PARTIAL = "node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, shared long, before long"


def _frame(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in schema.split(", "))])


_FOREST = _frame(FOREST)
_PARTIAL = _frame(PARTIAL)


def _batch(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """A batch of ``n`` rows; columns that are not given are NULL."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
    )


def common_turns(a: bytes, b: bytes) -> int:
    """How many turns two rows of digests share from the start."""
    n = min(len(a), len(b)) // DIGEST_BYTES
    if a[: n * DIGEST_BYTES] == b[: n * DIGEST_BYTES]:
        return n
    x, y = (np.frombuffer(k, np.int64, 2 * n) for k in (a, b))
    return int(np.argmax(x != y)) // 2


def prefix_names(key: bytes) -> list[bytes]:
    """A digest of the first d turns, for each d from 0."""
    digest = hashlib.blake2b(digest_size=DIGEST_BYTES)
    names = [digest.digest()]
    for at in range(0, len(key), DIGEST_BYTES):
        digest.update(key[at : at + DIGEST_BYTES])
        names.append(digest.digest())
    return names


class Forest:
    """The trie of sorted conversations: unbranched chains of nodes, found by unions in descending depth.

    ``depths`` are the numbers of turns, ``common[j]`` the turns that j shares with j - 1, ``sums`` the words of the first
    0, 1, ... turns of all conversations one after the other, that of j from ``sums_at[j]``.
    """

    def __init__(self, ids: np.ndarray, depths: np.ndarray, common: np.ndarray, sums: np.ndarray, sums_at: np.ndarray):
        n = len(ids)
        self.ids, self.depths, self.sums, self.sums_at = ids, depths, sums, sums_at
        is_leaf = np.append(common[1:] < depths[:-1], True)
        # of a union, at its first conversation
        self.up = list(range(n))
        self.last = list(range(n))
        self.top = depths.tolist()
        self.least = ids.tolist()
        self.shared = [0] * n
        self.leaves = is_leaf.astype(np.int64).tolist()
        self.children = [0] * n
        self.chains_below: list[list[int]] = [[] for _ in range(n)]
        #: first and last conversation, least and greatest depth, least id, shared words, leaves, children, parent's least id
        self.chains: list[list] = []
        weight = sums[sums_at + np.maximum(common, 0)].tolist()
        depth_of = common.tolist()
        for j in (np.argsort(-common[1:], kind="stable") + 1).tolist():
            self._unite(self._find(j - 1), self._find(j), depth_of[j], weight[j])
        if n:
            self._close(0, 0, None)

    def _find(self, j: int) -> int:
        up = self.up
        while up[j] != j:
            up[j] = up[up[j]]
            j = up[j]
        return j

    def _close(self, a: int, least_depth: int, into: list[int] | None) -> None:
        """The nodes of a union from its own depth up to ``least_depth`` are complete."""
        for k in self.chains_below[a]:
            self.chains[k][8:] = [self.least[a], a, self.last[a]]
        if into is not None:
            into.append(len(self.chains))
        self.chains.append(
            [a, self.last[a], least_depth, self.top[a], self.least[a], self.shared[a], self.leaves[a], self.children[a], None, None, None]
        )

    def _unite(self, a: int, b: int, depth: int, words: int) -> None:
        """Neighbouring unions a and b meet in a node of this depth."""
        for x in (a, b):
            if self.top[x] > depth:
                below: list[int] = []
                self._close(x, depth + 1, below)
                self.top[x], self.children[x], self.chains_below[x] = depth, 1, below
        self.up[b] = a
        self.last[a] = self.last[b]
        self.least[a] = min(self.least[a], self.least[b])
        self.shared[a] += self.shared[b] + words
        self.leaves[a] += self.leaves[b]
        self.children[a] += self.children[b]
        x, y = self.chains_below[a], self.chains_below[b]
        if len(x) < len(y):
            x, y = y, x
        x.extend(y)
        self.chains_below[a], self.chains_below[b] = x, []


def forest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id, words) of a partition -> its nodes, partial nodes of its two outer paths, pieces of id texts
    and the outer paths themselves."""
    part = TaskContext.get().partitionId()
    ids, depths, common, words, first_key, last_key = [], [], [], [], None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids.append(batch.column(1).to_numpy())
        words.append(batch.column(2).flatten().to_numpy(zero_copy_only=False))
        for key in batch.column(0).to_pylist():
            common.append(-1 if last_key is None else common_turns(last_key, key))
            depths.append(len(key) // DIGEST_BYTES)
            first_key, last_key = key if first_key is None else first_key, key
    if first_key is None:
        return
    id_, depth, shared = np.concatenate(ids), np.array(depths, np.int64), np.array(common, np.int64)
    sums_at = np.concatenate([[0], np.cumsum(depth + 1)])
    steps = np.zeros(sums_at[-1], np.int64)
    inner = np.ones(len(steps), bool)
    inner[sums_at[:-1]] = False
    steps[inner] = np.concatenate(words)
    sums = np.cumsum(steps)
    sums -= np.repeat(sums[sums_at[:-1]], depth + 1)
    forest = Forest(id_, depth, shared, sums, sums_at[:-1])
    yield from _nodes(forest, shared, part, prefix_names(first_key), prefix_names(last_key))
    yield _batch(
        _FOREST, 1, kind=["edge"], part=[part], node=[first_key], parent=[last_key], sums=[sums[: depth[0] + 1].tolist()]
    )


def _nodes(forest: Forest, common: np.ndarray, part: int, first: list[bytes], last: list[bytes]) -> Iterator[pa.RecordBatch]:
    n_rows = len(forest.ids)
    fields = list(zip(*forest.chains, strict=True))
    begin, end, least, top, conv, shared, leaves, children = (np.array(x, np.int64) for x in fields[:8])
    over = np.array([-1 if x is None else x for x in fields[8]], np.int64)
    over_begin = np.array([-1 if x is None else x for x in fields[9]], np.int64)
    over_end = np.array([-1 if x is None else x for x in fields[10]], np.int64)
    is_open = (begin == 0) | (end == n_rows - 1)

    # groups of equal conversations: texts of their ids
    starts = np.flatnonzero(np.append(True, (common[1:] != forest.depths[1:]) | (common[1:] != forest.depths[:-1])))
    stops = np.append(starts[1:], n_rows)
    group_of = {int(s): (int(s), int(e)) for s, e in zip(starts, stops, strict=True)}

    def ids_text(a: int, b: int) -> str:
        return ",".join(map(str, forest.ids[a:b].tolist()))

    whole = ~is_open
    sizes = (top - least + 1)[whole]
    row = np.repeat(np.flatnonzero(whole), sizes)
    depth = least[row] + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    is_top, is_first = depth == top[row], depth == least[row]
    ends = [NO_IDS] * len(row)
    for k in np.flatnonzero(is_top & (forest.depths[begin[row]] == depth)).tolist():
        ends[k] = hashlib.sha256(ids_text(*group_of[int(begin[row[k]])]).encode()).hexdigest()
    open_parent = is_first & ((over_begin[row] == 0) | (over_end[row] == n_rows - 1))
    parent = [None] * len(row)
    for k in np.flatnonzero(open_parent).tolist():
        parent[k] = (first if over_begin[row[k]] == 0 else last)[int(depth[k]) - 1]
    yield _batch(
        _FOREST,
        len(row),
        kind=["node"] * len(row),
        conv_id=conv[row],
        depth=depth,
        parent_conv_id=np.where(is_first, over[row], conv[row]),
        n_convs=(end - begin + 1)[row],
        n_children=np.where(is_top, children[row], 1),
        n_leaves=leaves[row],
        shared=shared[row],
        before=forest.sums[forest.sums_at[begin[row]] + np.maximum(depth - 1, 0)],
        ends=ends,
        parent=parent,
    )

    for k in np.flatnonzero(is_open).tolist():
        names = first if begin[k] == 0 else last
        levels = np.arange(least[k], top[k] + 1)
        m = len(levels)
        yield _batch(
            _FOREST,
            m,
            kind=["open"] * m,
            conv_id=np.full(m, conv[k]),
            depth=levels,
            n_convs=np.full(m, end[k] - begin[k] + 1),
            n_children=np.where(levels == top[k], children[k], 1),
            n_leaves=np.full(m, leaves[k]),
            shared=np.full(m, shared[k]),
            before=forest.sums[forest.sums_at[begin[k]] + np.maximum(levels - 1, 0)],
            node=[names[d] for d in levels.tolist()],
            parent=[names[d - 1] if d else None for d in levels.tolist()],
        )
        if forest.depths[begin[k]] == top[k]:
            a, b = group_of[int(begin[k])]
            for seq, at in enumerate(range(a, b, IDS_AT_ONCE)):
                piece = ids_text(at, min(b, at + IDS_AT_ONCE))
                yield _batch(_FOREST, 1, kind=["ends"], node=[names[int(top[k])]], part=[part], seq=[seq], ends=[piece])


def boundary_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(last key of a partition, first key of the next, its words) -> what the edge between the two adds to the partial nodes."""
    for batch in batches:
        for before, after, sums in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            shared = common_turns(before, after)
            names = prefix_names(after[: shared * DIGEST_BYTES])
            n = shared + 1
            yield _batch(
                _PARTIAL,
                n,
                node=names,
                parent=[None, *names[:-1]],
                depth=np.arange(n),
                n_convs=np.zeros(n, np.int64),
                # a child on both sides was counted twice
                n_children=np.append(np.full(shared, -1), 0),
                # the last conversation goes on in the next partition: no leaf
                n_leaves=np.full(n, -1 if shared == len(before) // DIGEST_BYTES else 0),
                shared=np.full(n, sums[shared]),
                before=[sums[max(d - 1, 0)] for d in range(n)],
            )


def digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, piece of its id text) -> node, digest of the pieces joined by commas."""
    schema = pa.schema([("node", pa.binary()), ("ends", pa.string())])
    node, digest = None, None
    for batch in batches:
        for name, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name != node:
                if node is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], schema=schema)
                node, digest = name, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], schema=schema)


def paths_of(turns: DataFrame, members: DataFrame | None) -> DataFrame:
    """(key, conv_id, words): the digests of a conversation's turns one after the other, and the words of each."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest: Column = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t"),
    )
    if members is not None:
        rows = rows.unionByName(members.select(F.col("conv_id").cast("long").alias("conv_id")), allowMissingColumns=True)
    grouped = rows.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return grouped.select(F.unhex(F.array_join("t.digest", "")).alias("key"), "conv_id", F.col("t.words").alias("words"))


def prefix_trie(turns: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, turn, role and text. A node is a distinct sequence of first turns (role and text); its
    conversations are those that begin with it. conv_id is the smallest of them, parent_conv_id that of the sequence
    without the last turn (NULL at the root, which has no turn). saved_tokens adds up, over the node and all nodes below,
    the words of the last turn times the conversations less one. ends_sha256 is the digest of the ids of the conversations that
    end here, ascending, joined by commas.

    Turns are ordered by ``turn``, NULL first, equal ones by a digest of role and text. NULL role and text are empty.
    Rows with a NULL conv_id are left out. ``members`` may list further conv_id, which are conversations
    without turns. Equal turns are told by 128-bit digests. Without conversations the result is empty; other columns are not looked at.

    A conversation is one row of 24 bytes a turn, so the longest one bounds a task's memory from below; its texts are not gathered.
    The digest of ids is sequential by definition: ids pass one task as pieces of text, in order.
    """
    paths = stored(paths_of(turns, members), "paths")
    ordered = paths.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = stored(ordered.mapInArrow(forest_batches, FOREST), "forest")

    partial = [c.split(" ")[0] for c in PARTIAL.split(", ")]
    # one row per partition
    before = F.lag("parent").over(Window.orderBy("part"))
    edges = found.filter("kind = 'edge'").select(before.alias("before"), F.col("node").alias("after"), "sums")
    crossing = edges.filter("before IS NOT NULL").mapInArrow(boundary_batches, PARTIAL)
    merged = (
        found.filter("kind = 'open'")
        .select(*partial)
        .unionByName(crossing)
        .groupBy("node")
        .agg(
            F.max("parent").alias("parent"),
            F.max("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "shared")],
            F.max("before").alias("before"),
        )
    )
    merged = stored(merged, "merged")
    pieces = found.filter("kind = 'ends'").select("node", "ends", "part", "seq")
    pieces = pieces.repartition("node").sortWithinPartitions("node", "part", "seq").select("node", "ends")
    ends = pieces.mapInArrow(digest_batches, "node binary, ends string")

    parents = broadcast_if_small(merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("open_conv_id")))
    nodes = found.filter("kind = 'node'")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "shared", "before", "ends"]
    inner = nodes.filter("parent IS NULL").select(*columns)
    below = nodes.filter("parent IS NOT NULL").drop("parent_conv_id").join(parents, "parent")
    outer = merged.join(parents, "parent", "left").join(ends, "node", "left")
    outer = outer.withColumn("ends", F.coalesce("ends", F.lit(NO_IDS)))
    every = inner
    for side in (below, outer):
        every = every.unionByName(side.withColumnRenamed("open_conv_id", "parent_conv_id").select(*columns))
    discard(paths)
    return every.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("shared") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
