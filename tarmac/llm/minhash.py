"""Near-duplicate documents: MinHash bands, odd sketches, links confirmed on whole shingle sets.

Each document is read once. From its set of five-word shingles come a 128-bit digest of the set, band keys from
MinHash samples of 128 functions, and an odd sketch: the least value in each of 4096 ranges of one hash function (up to
4096 more MinHash samples; of a small set nearly all its values) flips one bit of a bitmap, so that
the XOR of two bitmaps counts the samples in which two sets differ. Documents with equal sets collapse into one node. Nodes
that share a band key are candidates; the popcount of the XOR drops those that cannot reach the threshold,
whole texts decide about the rest.

Large groups are not expanded into pairs. First every node is compared with the first node of each of its buckets, then those
outside of a bucket's largest component with eight nodes of it; the most similar one is confirmed, which joins most of a group. Only buckets that still hold several components are searched further, between components only, with the sketch and
size test inside the join, which is work for the rows outside a bucket's largest component times its rows. What has not been compared then is either in one component already or excluded.

With 128 samples in 32 bands of 4, a pair at exactly 0.75 is missed with probability 5e-6 and more similar ones far
less often. The sketch test allows as many differing bits as sets at 0.75 have, and 4.5 standard deviations more: it drops
one in 300,000 of the pairs at exactly 0.75, whatever their size (none of 15,700 simulated ones of 50 to 18,200 shingles; the
farthest lay 3.4 deviations off). Of small sets it keeps few pairs below 0.65; two bitmaps of very long texts differ
in nearly half of their bits at 0.75 already, so more of those are left to the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.components import connected_components
from tarmac.llm.words import chunks, mix, shingle_hashes, shingles_of, signed, word_hashes
from tarmac.session import discard, stored

SHINGLE = 5
PERCENT = 75
SAMPLES = 128
BAND_ROWS = 4
RANGES = 4096
#: Nodes of a bucket's largest component that the others are compared with.
PIVOTS = 8
SKETCH_BITS = 2048
DEVIATIONS = 4.5

_random = np.random.Generator(np.random.PCG64(4))
_FACTOR = _random.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
_BAND = _random.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 512

SKETCHED = "doc_id long, n_shingles long, n_samples long, d0 long, d1 long, bands array<long>, sketch array<long>"


def minhash(values: np.ndarray) -> np.ndarray:
    """The least value of each of ``SAMPLES`` linear functions modulo 2^64 over a set of hashes."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), _BLOCK):
        block = values[i : i + _BLOCK, None] * _FACTOR
        block += _SHIFT
        np.minimum(least, block.min(axis=0), out=least)
    return least


def band_keys(samples: np.ndarray) -> np.ndarray:
    """(rows, bands) keys from (rows, SAMPLES) samples; keys of different bands differ."""
    parts = (samples * _BAND).reshape(len(samples), -1, BAND_ROWS).sum(axis=2, dtype=np.uint64)
    return mix(parts)


def odd_sketch(values: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of samples of a sorted set of hashes, and the bitmap of their parities as 64-bit numbers."""
    part = values >> np.uint64(64 - RANGES.bit_length() + 1)
    least = values[np.concatenate([[True], part[1:] != part[:-1]])] if len(values) else values
    odd = np.bincount((mix(least) & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return len(least), np.packbits(odd.astype(np.uint8)).view(np.uint64)


def sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> digest of the shingle set, band keys and odd sketch."""
    for batch in batches:
        for first, data, offsets in chunks(batch.column(1)):
            values, at = shingle_hashes(*word_hashes(data, offsets), SHINGLE)
            rows = len(offsets) - 1
            size, digest = np.zeros(rows, np.int64), np.zeros((rows, 2), np.uint64)
            samples, n_samples = np.zeros((rows, SAMPLES), np.uint64), np.zeros(rows, np.int64)
            sketch = np.zeros((rows, SKETCH_BITS // 64), np.uint64)
            for i in range(rows):
                own = np.unique(values[at[i] : at[i + 1]])
                size[i] = len(own)
                digest[i] = own.sum(dtype=np.uint64), mix(own ^ _SHIFT[0]).sum(dtype=np.uint64)
                samples[i] = minhash(own)
                n_samples[i], sketch[i] = odd_sketch(own)
            full = size > 0
            keys = band_keys(samples)

            def lists(matrix: np.ndarray, full: np.ndarray = full) -> pa.Array:
                ends = np.concatenate([[0], np.cumsum(full * matrix.shape[1])]).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(matrix[full].ravel())))

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, rows).cast(pa.int64()),
                    pa.array(size),
                    pa.array(n_samples),
                    pa.array(signed(digest[:, 0].copy())),
                    pa.array(signed(digest[:, 1].copy())),
                    lists(keys),
                    lists(sketch),
                ],
                ["doc_id", "n_shingles", "n_samples", "d0", "d1", "bands", "sketch"],
            )


def confirm_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) -> the pairs whose whole shingle sets reach the threshold."""
    for batch in batches:
        left, right = shingles_of(batch.column(2), SHINGLE), shingles_of(batch.column(3), SHINGLE)
        linked = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(left, right, strict=True)):
            common = len(np.intersect1d(x, y, assume_unique=True))
            linked[i] = common > 0 and 100 * common >= PERCENT * (len(x) + len(y) - common)
        yield batch.select([0, 1]).filter(pa.array(linked))


def differing_bits(left: str, right: str) -> Column:
    """Number of bits in which two sketches differ."""
    return F.expr(" + ".join(f"bit_count({left}[{i}] ^ {right}[{i}])" for i in range(SKETCH_BITS // 64)))


def allowed_bits(n: Column, m: Column, samples: Column) -> Column:
    """The most differing bits that a pair of sets of sizes n and m at the threshold shows.

    A range is empty with probability exp(-load); two sets agree in it if the least value of their union is common. That gives the
    differing samples of a pair at the threshold and, folded into the bitmap, its differing bits; both vary, and
    the bound is ``DEVIATIONS`` standard deviations above.
    """
    j = PERCENT / 100
    load = (n + m) / F.lit(2.0 * RANGES)
    filled = F.lit(1.0) - F.exp(-load)
    differ = samples * (F.lit(1.0) - F.lit(j) * (F.lit(1.0) - F.exp(-load * F.lit(2 / (1 + j)))) / filled)
    left_over = F.exp(-differ * F.lit(2 / SKETCH_BITS))
    mean = F.lit(SKETCH_BITS / 2) * (F.lit(1.0) - left_over)
    # a fixed number of samples falls into the bits: less varies than where their number does too
    folding = F.lit(SKETCH_BITS / 4) * (F.lit(1.0) - left_over * left_over) - differ * left_over * left_over
    sampling = F.lit(2.0) * differ * filled * left_over * left_over
    return mean + F.lit(DEVIATIONS) * F.sqrt(folding + sampling) + 1


def _possible(n: str, m: str, s: str, t: str, sketch: str, other: str) -> Column:
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT
    return sizes & (differing_bits(sketch, other) <= allowed_bits(F.col(n), F.col(m), F.col(s) + F.col(t)))


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, decided on the whole texts."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(confirm_batches, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * intersection >= 75 * union of their sets of five-word shingles; one
    to four words are one shingle, texts without words (NULL, empty) are linked with nothing.
    ``component_id`` is the smallest id reachable over links, ``kept`` marks it. Rows with one id are one document:
    their links are united, each row is returned. Rows with a NULL id are linked with nothing, have a
    NULL component and are kept. Other columns are not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketched = stored(docs.mapInArrow(sketch_batches, SKETCHED), "sketched")
    known = sketched.filter("doc_id IS NOT NULL AND n_shingles > 0")
    same = [F.any_value(c).alias(c) for c in ("n_shingles", "n_samples", "sketch", "bands")]
    nodes = stored(known.groupBy("d0", "d1").agg(F.min("doc_id").alias("node"), *same), "nodes")
    sets = nodes.select("d0", "d1", "node")
    # ids with several texts tie the nodes of these together
    spread = (F.min("d0") < F.max("d0")) | (F.min("d1") < F.max("d1"))
    several = known.groupBy("doc_id").agg(spread.alias("several")).filter("several").select("doc_id")
    ties = stored(several.join(known, "doc_id").join(sets, ["d0", "d1"]).select(F.col("doc_id").alias("a"), F.col("node").alias("b")), "ties")

    banded = nodes.select(F.explode("bands").alias("key"), "node")
    buckets = banded.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
    members = stored(banded.join(buckets.filter("pivot < last").drop("last"), "key"), "members")
    wanted = members.select("node").distinct()
    texts = stored(docs.join(wanted, docs.doc_id == wanted.node, "left_semi"), "texts")

    mine = nodes.select("node", F.col("n_shingles").alias("n"), F.col("n_samples").alias("s"), "sketch")
    theirs = mine.toDF("pivot", "m", "t", "other")

    def nearest(stars: DataFrame) -> DataFrame:
        """(a, b): each node and the most similar of its pivots that may be linked with it."""
        # a node has at most ``PIVOTS`` in each of its buckets
        pivots = stars.groupBy("node").agg(F.collect_set("pivot").alias("pivots"))
        pairs = pivots.join(mine, "node").select("*", F.explode("pivots").alias("pivot")).drop("pivots")
        possible = pairs.join(theirs, "pivot").filter(_possible("n", "m", "s", "t", "sketch", "other"))
        distance = (-differing_bits("sketch", "other") / (F.col("s") + F.col("t"))).alias("nearest")
        best = possible.groupBy("node").agg(F.max(F.struct(distance, "pivot")).alias("best"))
        return best.select(F.col("node").alias("a"), F.col("best.pivot").alias("b"))

    def steps_of(parts: DataFrame) -> DataFrame:
        return parts.filter("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))

    def by_part(parts: DataFrame) -> DataFrame:
        return members.join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("part"))

    def largest_parts(placed: DataFrame) -> DataFrame:
        """(key, main, pivots) of the buckets with several components: the largest one and some nodes of it."""
        any_nodes = [F.min_by("node", F.xxhash64("node", "key", F.lit(turn))) for turn in range(PIVOTS)]
        sizes = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n_nodes"), F.array(*any_nodes).alias("pivots"))
        largest = F.max(F.struct("n_nodes", "part", "pivots")).alias("largest")
        several = sizes.groupBy("key").agg(largest, F.count(F.lit(1)).alias("n_parts")).filter("n_parts > 1")
        return several.select("key", F.col("largest.part").alias("main"), F.col("largest.pivots").alias("pivots"))

    # every node against the most similar first node of its buckets; a row of the documents makes one tie and one node at
    # most, a node one link and one step
    most = 2 * sketched.count()
    links = _confirm(nearest(members.filter("node != pivot")), texts)
    parts = stored(connected_components(links.unionByName(ties), most), "parts")
    placed = by_part(parts)
    outside = placed.join(largest_parts(placed), "key").filter("part != main").select("node", F.explode("pivots").alias("pivot"))
    links = _confirm(nearest(outside), texts)
    joined = stored(connected_components(steps_of(parts).unionByName(links), most), "parts")

    # buckets that still hold several components: pairs between those. Rows of a bucket's largest component, which may
    # be nearly all of a hot bucket, meet rows outside of it only. A pair is made in the first bucket it shares: a bucket
    # with two components is open, so all that it shares are
    placed = by_part(joined)
    open_rows = placed.join(largest_parts(placed).drop("pivots"), "key")
    traits = nodes.select("node", "n_shingles", "n_samples", "sketch", "bands")
    open_rows = stored(open_rows.join(traits.toDF("node", "n", "s", "sketch", "bands"), "node"), "open")
    outside = open_rows.filter("part != main").drop("main")
    other = open_rows.toDF("node2", "key", "part2", "main", "n2", "s2", "sketch2", "bands2")
    between = (F.col("part") != F.col("part2")) & ((F.col("part2") == F.col("main")) | (F.col("node") > F.col("node2")))
    crossing = outside.join(
        other,
        (outside.key == other.key)
        & between
        & _possible("n", "n2", "s", "s2", "sketch", "sketch2")
        & (F.array_intersect("bands", "bands2")[0] == outside.key),
    )
    more = _confirm(crossing.select(F.greatest("node", "node2").alias("a"), F.least("node", "node2").alias("b")), texts)
    whole = stored(connected_components(steps_of(joined).unionByName(more)), "parts")
    for frame in (texts, members, ties, parts, joined, open_rows):
        discard(frame)

    of_set = sets.join(whole, "node", "left").select("d0", "d1", F.coalesce("component", "node").alias("of_set"))
    # rows with one id are one document: the id itself may be a node under another of its texts
    own = whole.select(F.col("node").alias("doc_id"), F.col("component").alias("of_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.least(F.coalesce("of_set", "doc_id"), F.coalesce("of_id", "doc_id")))
    return (
        sketched.select("doc_id", "n_shingles", "d0", "d1")
        .join(of_set.withColumn("full", F.lit(True)), ["d0", "d1"], "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("of_set")).alias("of_set"))
        .join(own, "doc_id", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that stand for their group of near-duplicates."""
    out = near_duplicates(docs, id_col, text_col).filter("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(out, docs[id_col] == out["gone"], "left_anti")
