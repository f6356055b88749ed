"""Near-duplicate documents and vectors, and components, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import components, embeddings, minhash
from tarmac.llm.components import connected_components
from tarmac.llm.words import shingles_of, word_bounds, word_hashes, chunks
from tests.llm import brute, data

DOC = "doc_id long, text string"


def found(spark, rows):
    return {
        r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    }


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (100, 101)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_small_tables_of_components_are_few_files(spark, monkeypatch):
    """Also where shuffles have many partitions that Spark does not put together; more rows make more files."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    written, stored = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, label: written.append(stored(df, label)) or written[-1])
    monkeypatch.setattr(components, "discard", lambda frame: None)
    edges = spark.createDataFrame([(i - 1, i) for i in range(1000) if i % 10], "a long, b long")
    cores = spark.sparkContext.defaultParallelism
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        # rows a file, most edges, files of the first table, files of the others
        for rows, most, first, others in ((500, None, 60, cores), (500, 900, cores, cores), (30, 900, 30, 30)):
            monkeypatch.setattr(components, "ROWS_A_FILE", rows)
            written.clear()
            parts = connected_components(edges, most)
            files = [len(frame.inputFiles()) for frame in written]
            assert {r.node: r.component for r in parts.collect()} == {i: i - i % 10 for i in range(1000)}
            # Spark leaves out the files of empty partitions
            assert len(files) > 2 and 0.8 * first <= files[0] <= first and files[1] == others
            assert rows != 500 or parts.rdd.getNumPartitions() == cores
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_words_are_cut_at_ascii_space_only():
    import pyarrow as pa

    texts = ["", None, "A b", "a b c d", " \t\n\x0b\x0c\r", "ABC abc aBc", "x" * 70_000 + " y", "\x1c z"]
    column = pa.array(texts)
    counted = []
    for _, bytes_, offsets in chunks(column, 64):
        counted += list(np.diff(word_bounds(bytes_, offsets)[2]))
    assert counted == [len(brute.words(t)) for t in texts]
    _, bytes_, offsets = next(chunks(pa.array(["ABC abc aBc d"])))
    hashes, _ = word_hashes(bytes_, offsets)
    assert len(set(hashes.tolist())) == 2
    assert [len(s) for s in shingles_of(pa.array(texts + ["a b c d e f a b c d e"]), 5)] == [
        len(brute.shingles(t)) for t in texts + ["a b c d e f a b c d e"]
    ]


def test_near_duplicates_equal_brute_force_on_a_table(spark):
    rows = data.rows("documents", "doc_id, text")
    got = {r.doc_id: r for r in minhash.near_duplicates(data.clashing(data.frame(spark, "documents"))).collect()}
    want = brute.near_duplicates(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    assert any(i != c for i, (_, c) in want.items())


def test_near_duplicates_around_the_threshold_and_in_large_groups(spark):
    random.seed(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 260):  # every copy has words of its own; many pairs of copies lie below the threshold
        w = list(base)
        for at in random.sample(range(120), random.choice([1, 2, 3, 4])):
            w[at] = f"x{i}_{at}"
        rows.append((i, " ".join(w)))
    passage = " ".join(f"common{i}" for i in range(30))
    for i in range(300, 420):  # a passage that many share
        rows.append((i, passage + " " + " ".join(f"d{i}_{j}" for j in range(40))))
    for i in range(500, 540):  # a chain: neighbours are linked, ends are not
        rows.append((i, " ".join(f"c{j}" for j in range((i - 500) * 4, (i - 500) * 4 + 60))))
    assert found(spark, rows) == brute.near_duplicates(rows)


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(f"l{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a B"), (5, "A b"), (6, "a b c"), (7, long), (8, long + " end"), (9, "x" * 200_000)]
    assert found(spark, rows) == brute.near_duplicates(rows)
    twice = [(5, "a b c d e f"), (5, "a b c d e f"), (9, "A b c d e f"), (None, "a b c d e f"), (None, None)]
    got = minhash.near_duplicates(spark.createDataFrame(twice, DOC)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, True), (0, 0, True), (5, 5, True), (5, 5, True), (9, 5, False)
    ]
    assert minhash.near_duplicates(spark.createDataFrame([], DOC)).count() == 0
    # rows with one id are one document
    bridge = [(3, "a b c d e f"), (3, "g h i j k l"), (1, "a b c d e f"), (2, "g h i j k l")]
    assert {r.component_id for r in minhash.near_duplicates(spark.createDataFrame(bridge, DOC)).collect()} == {1}


def test_keep_one_of_each_keeps_all_columns(spark):
    docs = data.clashing(data.frame(spark, "documents"))
    kept = minhash.keep_one_of_each(docs)
    want = {i for i, (_, c) in brute.near_duplicates(data.rows("documents", "doc_id, text")).items() if i == c}
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(want)


def test_odd_sketch_estimates_the_similarity(spark):
    random_ = np.random.default_rng(1)
    rows, truth = [], []
    for size in (20, 150, 1000, 8000, 18_200):
        for share in (0.95, 0.9, 6 / 7, 0.6):  # 6/7 of each set in common: similarity 0.75
            for _ in range(40):
                common = random_.integers(0, 1 << 63, int(size * share), dtype=np.uint64) * np.uint64(2)
                own = [random_.integers(0, 1 << 63, size - len(common), dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in "ab"]
                sets = [np.unique(np.concatenate([common, x])) for x in own]
                truth.append(len(np.intersect1d(*sets)) / len(np.union1d(*sets)))
                (s, x), (t, y) = (minhash.odd_sketch(v) for v in sets)
                rows.append((len(rows), size, size, s, t, *(v.view(np.int64).tolist() for v in (x, y))))
    frame = spark.createDataFrame(rows, "i long, n long, m long, s long, t long, x array<long>, y array<long>")
    kept = {r.i for r in frame.filter(minhash._possible("n", "m", "s", "t", "x", "y")).collect()}
    assert all(i in kept for i, j in enumerate(truth) if j >= 0.745)
    assert not any(i in kept for i, j in enumerate(truth) if j < 0.5 and 20 < rows[i][1] < 10_000)


VEC = "vec_id long, embedding array<float>, label int"


def linked(spark, rows):
    got = embeddings.near_duplicate_vectors(spark.createDataFrame(rows, VEC)).collect()
    return {r.vec_id: (r.n_links, r.component_id) for r in got}


def brute_links(rows):
    groups = {}
    for i, v, label in rows:
        if label is not None and brute.usable(v):
            groups.setdefault((label, len(v)), []).append((i, np.array(v, np.float32).astype(float)))
    links = []
    for group in groups.values():
        ids = [i for i, _ in group]
        x = np.stack([v for _, v in group])
        n = np.linalg.norm(x, axis=1)
        a, b = np.nonzero(np.triu((x @ x.T) / n[:, None] / n[None] >= embeddings.COSINE, 1))
        links += [(ids[p], ids[q]) for p, q in zip(a, b, strict=True)]
    return links


def test_vectors_against_brute_force(spark):
    random_ = np.random.default_rng(5)
    rows, number = [], 0
    for label in (0, 1):
        for centre in random_.standard_normal((60, 64)):
            for spread in (0.0, 0.0, 0.2, 0.28, 0.33, 0.4):
                v = centre + spread * random_.standard_normal(64)
                rows.append((number, [float(x) for x in v], label))
                number += 1
    centre = random_.standard_normal(64)
    for _ in range(1500):  # one large group, more than a block
        rows.append((number, [float(x) for x in centre + 0.2 * random_.standard_normal(64)], 1))
        number += 1
    links = brute_links(rows)
    degree = dict.fromkeys((r[0] for r in rows), 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    got = linked(spark, rows)
    assert all(got[i][0] <= degree[i] for i in got)
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(degree.values())
    want = brute.components(degree, links)
    assert np.mean([got[i][1] == want[i] for i in got]) >= 0.97


def test_vectors_of_a_table(spark):
    rows = data.rows("embeddings", "vec_id, embedding, label")
    links = brute_links(rows)
    got = {r.vec_id: r for r in embeddings.near_duplicate_vectors(data.clashing(data.frame(spark, "embeddings"))).collect()}
    assert len(got) == len(rows)
    assert sum(r.n_links for r in got.values()) == 2 * len(links)
    assert {i: r.component_id for i, r in got.items()} == brute.components([r[0] for r in rows], links)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0] + [0.0] * 7
    rows = [(1, one, 0), (2, [2 * x for x in one], 0), (3, one, 0), (4, one, 1), (5, one, None), (6, None, 0), (7, [], 0)]
    rows += [(8, [0.0] * 8, 0), (9, [nan, *one[1:]], 0), (10, [inf, *one[1:]], 0), (11, [None, *one[1:]], 0), (12, one[:7], 0), (None, one, 0)]
    got = linked(spark, rows)
    assert got[1] == (2, 1) and got[2] == (2, 1) and got[3] == (2, 1)
    assert all(got[i] == (0, i) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12))
    assert got[None] == (0, None)
    assert embeddings.near_duplicate_vectors(spark.createDataFrame([], VEC)).count() == 0


@pytest.mark.parametrize("largest", [0, 10, 1000, 10**6, 10**9])
def test_keys_reach_the_recall(largest):
    bits, keys = embeddings.plan_keys(largest)
    agree = (1 - np.arccos(embeddings.COSINE) / np.pi) ** bits
    assert (1 - agree) ** keys <= embeddings.MISS
    assert F is not None and bits >= 4
