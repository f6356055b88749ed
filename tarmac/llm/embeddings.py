"""Near-duplicate vectors: randomly rotated binary codes with stored correction factors.

A vector of length one is rotated by several random rotations; its code is the signs of all coordinates, its factor the inner product
of code and rotated vector. <code, other> / factor estimates the cosine without bias, within a bound that follows
from the factor with high confidence. Runs of code bits are bucket keys: similar vectors agree in many bits. How many
bits and keys are used follows from the number of vectors, so that buckets stay small and a pair at the threshold is
missed with a probability of ``MISS`` at most.

In a bucket the estimates rule out most pairs; pairs whose bound reaches the threshold are recomputed in double
precision from the vectors themselves. A pair counts in the first bucket that it shares. A bucket returns sums per vector and a
spanning forest, never its pairs. Large buckets are split into blocks, compared block with block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.components import connected_components
from tarmac.llm.words import mix, signed
from tarmac.session import discard, stored

COSINE = 0.93
MISS = 0.005
#: Expected vectors in a bucket, and the most that are compared with each other at once.
BUCKET = 48
BLOCK = 1024
LEAST_CODE_BITS = 256
#: Width of the confidence bound in standard deviations.
CONFIDENCE = 4.0

CODED = "label int, node long, copies long, vector array<double>, code binary, factor double, keys array<long>"
FOUND = "a long, b long, n long"


def plan_keys(largest: int) -> tuple[int, int]:
    """Bits in a key, and keys, for labels of up to ``largest`` vectors."""
    bits = max(4, round(math.log2(max(largest, 1) / BUCKET))) if largest > BUCKET else 4
    agree = (1 - math.acos(COSINE) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree))


@lru_cache(maxsize=8)
def rotations(dim: int, n: int) -> np.ndarray:
    """``n`` random rotations of ``dim`` coordinates, one below the other."""
    random = np.random.Generator(np.random.PCG64([dim, 6]))
    return np.concatenate([np.linalg.qr(random.standard_normal((dim, dim)))[0] for _ in range(n)])


def _turns(dim: int, bits: int, keys: int) -> int:
    return -(-max(bits * keys, LEAST_CODE_BITS) // dim)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def code_batches(bits: int, keys: int):
    """A function for mapInArrow: (label, node, copies, vector) -> code, factor and bucket keys."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3)
            sizes = vectors.value_lengths().to_numpy()
            for dim in np.unique(sizes):
                own = batch.filter(pa.array(sizes == dim))
                x = _unit(own.column(3).flatten().to_numpy().reshape(-1, dim))
                turned = x @ rotations(int(dim), _turns(int(dim), bits, keys)).T
                sign = turned > 0
                factor = np.abs(turned).sum(axis=1) * math.sqrt(dim) / turned.shape[1]
                runs = sign[:, : bits * keys].reshape(len(x), keys, bits).astype(np.uint64)
                number = (runs << np.arange(bits, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)
                label = own.column(0).to_numpy().astype(np.int64).astype(np.uint64)
                key = mix(mix(mix(label)[:, None] + np.arange(keys, dtype=np.uint64) + np.uint64(int(dim) << 20)) + number)
                at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * keys)
                packed = np.packbits(sign, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *own.columns[:4],
                        pa.array([row.tobytes() for row in packed], pa.binary()),
                        pa.array(factor),
                        pa.ListArray.from_arrays(at, pa.array(signed(key.ravel()))),
                    ],
                    ["label", "node", "copies", "vector", "code", "factor", "keys"],
                )

    return apply


def compare(x: np.ndarray, code: np.ndarray, factor: np.ndarray, keys: np.ndarray, label: np.ndarray, band: int, side: np.ndarray):
    """Index pairs of linked vectors of a bucket: all pairs where ``side`` is constant, else between the sides."""
    turn = rotations(x.shape[1], code.shape[1] // x.shape[1])
    unit = _unit(x)
    width = code.shape[1]
    turned = (unit @ turn.T).astype(np.float32) / math.sqrt(width / x.shape[1])
    sign = (code.astype(np.float32) * 2 - 1) / math.sqrt(width)
    slack = CONFIDENCE * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(width - 1, 1)) + 1e-5
    if side.min() == side.max():
        left = right = np.arange(len(x))
    else:
        left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side != side.min())
    above = (sign[left] @ turned[right].T) / factor[left][:, None] + slack[left][:, None] >= COSINE
    above &= ((sign[right] @ turned[left].T) / factor[right][:, None] + slack[right][:, None] >= COSINE).T
    above &= label[left][:, None] == label[right][None, :]
    if left is right:
        above = np.triu(above, 1)
    i, j = np.nonzero(above)
    i, j = left[i], right[j]
    if band:
        # pairs that share an earlier key are compared there
        fresh = np.ones(len(i), bool)
        for k in range(band):
            fresh &= keys[i, k] != keys[j, k]
        i, j = i[fresh], j[fresh]
    norm = np.linalg.norm(x, axis=1)
    keep = np.zeros(len(i), bool)
    for a in range(0, len(i), 1 << 16):
        p, q = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
        keep[a : a + (1 << 16)] = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q]) >= COSINE
    return i[keep], j[keep]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the smallest place connected with it over the pairs."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def bucket_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, low, high): compares each group; per node how many links, and edges that connect it."""
    rest: pa.Table | None = None

    def groups(table: pa.Table, whole: bool):
        marks = np.stack([table.column(c).to_numpy() for c in ("key", "low", "high")])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1), table.num_rows]
        for a, b in zip(cuts[: -1 if whole else -2], cuts[1 : None if whole else -1], strict=True):
            if b - a > 1:
                found = _group(table.slice(a, b - a))
                if found is not None:
                    yield found
        return table.slice(cuts[-2])

    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch])
            rest = yield from groups(table if rest is None else pa.concat_tables([rest, table]), False)
    if rest is not None and rest.num_rows:
        yield from groups(rest, True)


def _group(rows: pa.Table) -> pa.RecordBatch | None:
    rows = rows.combine_chunks()
    get = lambda c: rows.column(c).to_numpy()
    vectors = rows.column("vector").combine_chunks()
    dim = int(vectors.value_lengths()[0].as_py())
    x = vectors.flatten().to_numpy().reshape(len(rows), dim)
    keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    code = np.unpackbits(np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(rows), -1), axis=1)
    code = code[:, : code.shape[1] // dim * dim]
    i, j = compare(x, code, get("factor"), keys, get("label"), int(rows.column("band")[0].as_py()), get("block"))
    if not len(i):
        return None
    node, copies = get("node"), get("copies")
    n = np.zeros(len(rows), np.int64)
    np.add.at(n, i, copies[j])
    np.add.at(n, j, copies[i])
    low = forest(len(rows), i, j)
    some, edge = np.flatnonzero(n), np.flatnonzero(low != np.arange(len(rows)))
    a = np.concatenate([node[some], node[edge]])
    b = np.concatenate([node[some], node[low[edge]]])
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.concatenate([n[some], np.zeros(len(edge), np.int64)]))], ["a", "b", "n"])


def near_duplicate_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors with equal labels are linked when their cosine, in double precision, is at least 0.93. ``n_links``
    counts the other rows linked with this one, equal vectors included. ``component_id`` is the smallest id reachable,
    ``kept`` marks it. Vectors that are NULL, empty, zero or hold NULL or non-finite numbers, and rows with a NULL label
    or id, are linked with nothing; with a NULL id the component is NULL and the row is kept. Vectors of
    different length are not compared. Rows with one id are one node, each of them a vector of its own for the counts.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("int").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & F.exists("vector", lambda v: v != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    nodes = (
        rows.filter("usable").groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    )
    nodes = stored(nodes.select("label", "node", "copies", "vector"), "vectors")
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, keys = plan_keys(largest)
    coded = stored(nodes.mapInArrow(code_batches(bits, keys), CODED), "coded")

    spread = coded.select("node", "label", F.posexplode("keys").alias("band", "key"))
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK)
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    with_block = (
        spread.join(shared, "key").withColumn("blocks", blocks).withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
        .select("node", "label", "band", "key", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )
    loaded = with_block.join(coded, ["node", "label"])
    grouped = loaded.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    found = stored(grouped.mapInArrow(bucket_batches, FOUND), "found")
    counts = found.filter("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    whole = stored(connected_components(found.filter("n = 0").select("a", "b")), "parts")

    known = (
        nodes.select("label", "vector", "node", "copies")
        .join(counts, "node", "left")
        .join(whole, "node", "left")
        .select(
            F.col("label").alias("of_label"),
            F.col("vector").alias("of_vector"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("part"),
        )
    )
    linked = rows.filter("usable").join(
        known, (F.col("label") == F.col("of_label")) & (F.col("vector") == F.col("of_vector"))
    ).select("vec_id", "n_links", F.col("part").alias("component_id"))
    alone = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = stored(linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))), "linked")
    for frame in (nodes, coded, found, whole):
        discard(frame)
    return out
