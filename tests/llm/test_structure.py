"""Runs of words, conversation tries and repeated byte strings against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tarmac.llm import periodic, prefix_trie, suffix_dedup
from tarmac.llm.queries import QUERIES, with_planted_run, with_shared_openings
from tests.llm import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string"


def hexed(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def plain_runs(w):
    """(start, length, period) of all runs, straight from the definition."""
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            e = i + q
            if e - s >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(s, e - p)) for p in range(1, q)):
                out.add((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_runs_of_random_words():
    draw = random.Random(1)
    for _ in range(200):
        docs = []
        for _ in range(draw.randint(1, 6)):
            k, letters = draw.choice([0, 1, 3, 10, 40, 120]), draw.choice([1, 2, 2, 3, 8])
            w = [draw.randrange(letters) for _ in range(k)]
            if k > 5 and draw.random() < 0.6:
                a = draw.randrange(k)
                p = draw.randint(1, max(1, (k - a) // 4))
                w = w[:a] + [w[a + (i - a) % p] for i in range(a, k)]
            docs.append(w)
        found = periodic.find_runs(np.array([x for w in docs for x in w], np.int64), np.cumsum([0] + [len(w) for w in docs]))
        got = [[tuple(map(int, r)) for d, *r in zip(*found, strict=True) if d == i] for i in range(len(docs))]
        assert got == [plain_runs(w) for w in docs]


@pytest.mark.parametrize("back", [False, True])
def test_grammar_extensions(back):
    draw = random.Random(2)
    for size in (2, 30, 2000):
        w = [draw.randrange(2) for _ in range(size)]
        w = w + w[size // 3 :] + [0] * 50 + w[: size // 2]
        spread = np.array([*w, 2], np.int64)
        grammar = periodic.Grammar(spread, 2, 1)
        assert len(grammar.symbols[-1]) == 2
        i = np.array([draw.randrange(len(w) - 1) for _ in range(500)])
        j = np.array([draw.randrange(x + 1, len(w)) for x in i])

        def plain(a, b, w=w):
            n = 0
            while a - n - 1 >= 0 and w[a - n - 1] == w[b - n - 1] if back else b + n < len(w) and w[a + n] == w[b + n]:
                n += 1
            return n

        assert grammar.extension(i, j, back).tolist() == [plain(a, b) for a, b in zip(i, j, strict=True)]


def test_runs_of_odd_rows(spark):
    rows = [
        (1, "A a a a a a a B"), (2, None), (3, ""), (4, " \n\t "), (5, "x y " * 9_000 + "end"), (6, "x y x y x y x y"), (6, "x y x y x y x y"),
        (None, "q q q q q q"), (7, "é ü é ü é ü é ü   w"), (8, "a b a b a b a"), (9, "one\nword\x0bnext"), (10, "k " * 5), (11, "p q r " * 4 + "p q q q q q q q q"),
    ]
    got = periodic.periodic_runs(data.clashing(spark.createDataFrame(rows, DOC))).collect()
    want = []
    for doc_id, text in rows:
        w = WORD.findall(text or "")
        want.append((doc_id, len(w), plain_runs(w) if len(w) < 100 else [(0, 18_000, 2)], plain_collapsed(w, plain_runs(w)) if len(w) < 100 else "x y end"))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str) == sorted(want, key=str)
    assert periodic.periodic_runs(spark.createDataFrame([], DOC)).collect() == []
    moved = {r.doc_id: r.text for r in with_planted_run(spark.createDataFrame([(i, "a b c d  e\nf g h i j k l m n") for i in range(60)], DOC)).collect()}
    assert all(WORD.findall(t) == planted(i, "a b c d e f g h i j k l m n") for i, t in moved.items())


def test_run_query(spark):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, data.SF).collect()}
    rows = data.rows("documents", "doc_id, text")
    assert len(got) == len(rows)
    for doc_id, text in rows:
        w = planted(doc_id, text)
        if len(w) > 3_000:
            continue
        runs = plain_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hexed("".join(f"{s},{n},{q}\n" for s, n, q in runs)) and r.collapsed_sha256 == hexed(plain_collapsed(w, runs))


TURN = "conv_id long, turn long, role string, text string"


def plain_trie(conversations):
    """id -> list of (role, text) gives the rows of ``prefix_trie``."""
    nodes = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {x: [] for x in nodes}
    for x in nodes:
        if x:
            children[x[:-1]].append(x)

    def below(x):
        return [x] + [z for y in children[x] for z in below(y)]

    out = []
    for x, members in nodes.items():
        own = below(x)
        saved = sum((len(nodes[y]) - 1) * len(WORD.findall(y[-1][1])) for y in own if y)
        ends = ",".join(str(c) for c in sorted(members) if len(conversations[c]) == len(x))
        parent = min(nodes[x[:-1]]) if x else None
        leaves = sum(not children[y] for y in own)
        out.append((min(members), len(x), parent, len(members), len(children[x]), leaves, saved, hexed(ends)))
    return sorted(out, key=str)


def trie_of(spark, conversations, parts=None):
    rows = [(c, i, *t) for c, turns in conversations.items() for i, t in enumerate(turns)]
    turns = data.clashing(spark.createDataFrame(rows, TURN))
    members = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts or before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return sorted((tuple(r) for r in prefix_trie.prefix_trie(turns, members).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", range(4))
def test_trie_over_partitions(spark, seed):
    draw = random.Random(seed)
    letters = ["a b", "c", "d e f", ""][: 1 + seed]
    conversations = {c: [("user", draw.choice(letters)) for _ in range(draw.choice([0, 1, 2, 3, 6]))] for c in range(-5, 90)}
    copies = [("user", "a b"), ("assistant", "c")] * 3
    conversations |= {1000 - c: copies for c in range(60)}
    assert trie_of(spark, conversations, 16) == plain_trie(conversations)


def test_trie_of_odd_rows(spark):
    one = {7: [("user", "x y")]}
    assert trie_of(spark, one) == plain_trie(one) == [(7, 0, None, 1, 1, 1, 0, hexed("")), (7, 1, 7, 1, 0, 1, 0, hexed("7"))]
    assert trie_of(spark, {3: [], 2: []}) == [(2, 0, None, 2, 0, 1, 0, hexed("2,3"))]
    assert trie_of(spark, {}) == []
    long = {1: [("user", "w " * 30_000)] * 60, 2: [("user", "w " * 30_000)] * 59, 3: [("a", "")] * 70}
    assert trie_of(spark, long) == plain_trie(long)
    rows = [(1, None, "user", "b"), (1, 0, None, None), (2, 5, "user", "b"), (2, 9, "", ""), (None, 0, "user", "x"), (3, 0, "user", "b"), (3, 0, "user", "b"), (4, 0, "user", "b")]
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, TURN)).collect()), key=str)
    b = ("user", "b")
    assert got == plain_trie({1: [b, ("", "")], 2: [b, ("", "")], 3: [b, b], 4: [b]})


def test_shared_openings(spark):
    own = {c: [("user", f"{c} {i}") for i in range(c % 7)] for c in range(1, 130)}
    del own[40]
    rows = [(c, i, *t) for c, turns in own.items() for i, t in reversed(list(enumerate(turns)))]
    turns, members = with_shared_openings(spark.createDataFrame(rows, TURN))
    got = {r.conv_id: [] for r in members.collect()}
    for r in sorted(turns.collect(), key=lambda r: r.turn):
        got[r.conv_id].append((r.role, r.text))
    assert got.keys() == {c for c, t in own.items() if t}
    for c in got:
        h = zlib.crc32(str(c).encode()) % 4
        assert got[c] == own.get(c - c % 20, [])[:h] + own[c][h:]


def plain_cuts(docs, length=100):
    """[(id, bytes)] with unique ids in order -> id: (merged spans, bytes kept)."""
    seen, out = set(), {}
    for doc_id, text in docs:
        gone = np.zeros(len(text) + 1, np.int64)
        for i in range(len(text) - length + 1):
            window = text[i : i + length]
            if window in seen:
                gone[i] += 1
                gone[i + length] -= 1
            seen.add(window)
        gone = np.cumsum(gone[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
        out[doc_id] = [tuple(map(int, x)) for x in edges.reshape(-1, 2)], bytes(np.frombuffer(text, np.uint8)[~gone])
    return out


def test_windows_are_sorted():
    draw = random.Random(3)
    for letters, pieces in (("a", 5), ("ab", 30), ("abcdefgh ", 40), ("aaaaaaaab", 30)):
        base = [bytes(draw.choice(letters.encode()) for _ in range(400)) for _ in range(3)]
        cuts = [(draw.choice(base), draw.randrange(200), draw.randrange(100, 169)) for _ in range(pieces)]
        texts = [b[s : s + n] for b, s, n in cuts]
        sizes = np.array([len(t) for t in texts])
        first = np.cumsum(sizes + 1) - (sizes + 1)
        text = np.frombuffer(b"".join(bytes(x + 1 for x in t) + b"\0" for t in texts), np.uint8)
        words = suffix_dedup._words(text)
        got = suffix_dedup.suffix_array(text, first, sizes - 99, words)
        windows = [text[i : i + 100].tobytes() for i in got]
        assert windows == sorted(windows) and sorted(got) == [i for f, n in zip(first, sizes, strict=True) for i in range(f, f + n - 99)]
        shared = [0] + [next((k for k in range(100) if a[k] != b[k]), 100) for a, b in zip(windows, windows[1:], strict=False)]
        assert suffix_dedup.common_prefixes(words, got).tolist() == shared


def texts_with_repeats(draw, n):
    letters = "etaoin shrdlu é\n"
    base = "".join(draw.choice(letters) for _ in range(3_000))
    out = []
    for _ in range(n):
        kind = draw.randrange(7)
        own = "".join(draw.choice(letters) for _ in range(draw.choice([0, 50, 300])))
        a, m = draw.randrange(2_000), draw.choice([60, 99, 100, 101, 150, 400, 900])
        piece = base[a : a + m]
        out.append([own, own + piece, piece + own, piece + own + piece, piece[:50] * 8, "x" * m, base[:400] + own][kind])
    return out


@pytest.mark.parametrize("hot", [None, 1])
def test_repeated_strings(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(suffix_dedup, "HOT_ANCHOR", hot)
    for seed in range(2):
        docs = list(enumerate(texts_with_repeats(random.Random(seed), 150)))
        want = plain_cuts([(i, t.encode()) for i, t in docs])
        frame = data.clashing(spark.createDataFrame(list(reversed(docs)), DOC)).repartition(5)
        got = suffix_dedup.drop_repeated_strings(frame).collect()
        assert {r.doc_id: ([tuple(s) for s in r.spans], bytes(r.kept)) for r in got} == want
        assert len(got) == len(docs) and {r.doc_id: r.n_bytes for r in got} == {i: len(t.encode()) for i, t in docs}


def test_repeated_strings_of_odd_rows(spark):
    long, other = "abcdefghij" * 30_000, "".join(chr(97 + i * i % 23) + str(i) for i in range(60))
    rows = [(1, None), (2, ""), (3, long), (4, other), (4, other), (None, other[:120]), (5, "é" * 60), (6, "é" * 60), (7, other[:99]), (4, "z" + other)]
    got = suffix_dedup.drop_repeated_strings(spark.createDataFrame(rows, DOC)).collect()
    found = sorted(((r.doc_id or 0, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got), key=str)
    n, third = len(other), len("z" + other)
    # both rows of document 4 are one; which text of id 4 comes first follows from a digest
    ends = {r[1]: r for r in found if r[0] == 4}
    assert [r for r in found if r[0] != 4] == sorted(
        [(0, 120, [], other[:120].encode()), (1, 0, [], b""), (2, 0, [], b""), (3, 300_000, [(10, 300_000)], b"abcdefghij"),
         (5, 120, [(2, 120)], "é".encode()), (6, 120, [(0, 120)], b""), (7, 99, [], other[:99].encode())], key=str)
    assert sum(r[0] == 4 for r in found) == 3 and (ends[n][2], ends[third][2]) in (([(0, 120)], [(1, third)]), ([(0, n)], [(1, 121)]))
    assert suffix_dedup.drop_repeated_strings(spark.createDataFrame([], DOC)).collect() == []


def test_repeated_strings_of_documents(spark):
    rows = data.rows("documents", "doc_id, text", "true ORDER BY doc_id")
    want = plain_cuts([(i, (t or "").encode()) for i, t in rows])
    got = QUERIES["op13_suffix_dedup"](spark, data.SF).collect()
    assert len(got) == len(rows)
    for r in got:
        spans, kept = want[r.doc_id]
        assert (r.n_removed, r.n_spans, r.kept_sha256) == (r.n_bytes - len(kept), len(spans), hexed(kept))
