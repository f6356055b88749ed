"""Benchmark decontamination: BM25 over an inverted index of test items, then overlap of question and answer.

The test items are indexed, the training documents are the queries. Every document is cut into overlapping passages
at least one segment longer than any indexed part of an item, so that each part lies whole in some passage. Scores are BM25
divided by the score of the part itself, so one threshold fits short and long items.

Retrieval skips as block-max WAND does, without losing anything above the threshold: a word's largest weight in a block of
parts, added up over the different words of a passage, bounds the score of every part in the block. All
passages of a batch are bounded at once: a word counts in the passages that reach it and do not hold it before,
which is a range of passages, so running sums do. Only (passage, block) pairs whose bound reaches the threshold are
scored exactly. Retrieved documents are verified on word shingles of the whole text: those of the whole item, or those of
question and answer each on their own, wherever they stand. So the question is looked for as a part as well.
Items shorter than a shingle are not scored; they are looked for as runs of words.

Items are dealt into shards of bounded size; each shard's index is broadcast and all documents pass it once. Word frequencies
and average length are those of all items, so scores do not depend on the shards.
No document is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.frames import unused
from tarmac.llm.words import chunks, shingle_hashes, signed, word_hashes
from tarmac.session import discard, stored

K1, B = 1.2, 0.75
SCORE = 0.5
OVERLAP = 0.75
SHINGLE = 5
#: A whole question of at least so many words counts without its answer.
QUESTION_WORDS = 8
#: Items of so many words, up to a shingle, count wherever they occur; shorter ones only as a whole text.
RUN_WORDS = 3
SEGMENT = 16
#: Longer items are indexed in parts of about this many words.
PART_WORDS = 32
BLOCK = 8
#: Bounds of one shard of the index, which is what is broadcast at once.
SHARD_ITEMS = 512
SHARD_CHARS = 4_000_000

HIT = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("bm25", T.DoubleType()),
        T.StructField("overlap", T.DoubleType()),
        T.StructField("question_overlap", T.DoubleType()),
        T.StructField("answer_overlap", T.DoubleType()),
    ]
)


def _hashes(texts: list[str]) -> list[np.ndarray]:
    """Word hashes of each text."""
    out: list[np.ndarray] = []
    for _, data, offsets in chunks(pa.array(texts, pa.large_string())):
        words, first = word_hashes(data, offsets)
        out += [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    return out


def _shingles(words: np.ndarray) -> np.ndarray:
    return np.unique(shingle_hashes(words, np.array([0, len(words)]), SHINGLE)[0])


def _run(words: np.ndarray) -> np.uint64:
    return shingle_hashes(words, np.array([0, len(words)]), len(words))[0][0]


def answer_words(text: str) -> int:
    """How many words at the end are the answer: those of the last sentence; 0 if there is only one."""
    sentences = re.split(r"(?<=[.?!])\s+", text.strip())
    return len(sentences[-1].split()) if len(sentences) > 1 else 0


@dataclass
class Index:
    """Items, their shingles, and for blocks of their parts the weights of words."""

    item_ids: list[int]
    shingles: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # whole item, question, answer
    sides: list[tuple[np.ndarray, np.ndarray]]  # words of question and answer
    runs: dict[int, dict[int, list[int]]]  # number of words -> hash -> ids of the items shorter than a shingle
    run_words: int
    vocabulary: np.ndarray  # sorted word hashes
    maybe: np.ndarray  # by the low bits of a hash: may be in the vocabulary
    block_most: np.ndarray  # by word and block: largest weight in the block's parts
    blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # row of each word, weights by row and part, items of the parts
    passage: int  # segments in a passage


def _parts(words: np.ndarray) -> list[np.ndarray]:
    return np.array_split(words, -(-len(words) // PART_WORDS))


@dataclass
class Counts:
    """What BM25 knows of all items: number and words of their parts, and in how many parts each word is."""

    parts: int
    words: int
    vocabulary: np.ndarray  # sorted word hashes
    in_parts: np.ndarray


def part_counts(texts: list[str]) -> Counts:
    """The counts of these items; those shorter than a shingle are not scored."""
    parts = [p for words in _hashes(texts) if len(words) >= SHINGLE for p in _parts(words)]
    vocabulary, in_parts = np.unique(np.concatenate([np.zeros(0, np.uint64), *map(np.unique, parts)]), return_counts=True)
    return Counts(len(parts), sum(map(len, parts)), vocabulary, in_parts)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> (what, word, n) of each batch: the parts a word is in, or with a NULL word all parts and their words."""
    for batch in batches:
        known = part_counts(batch.column(0).to_pylist())
        words = pa.array([None, None, *signed(known.vocabulary).tolist()], pa.int64())
        what = pa.array(["parts", "words", *["word"] * len(known.vocabulary)])
        n = pa.array([known.parts, known.words, *known.in_parts.tolist()], pa.int64())
        yield pa.RecordBatch.from_arrays([what, words, n], ["what", "word", "n"])


def build_index(items: list[tuple[int, str]], run_words: int = RUN_WORDS, counts: Counts | None = None) -> Index | None:
    """The index of one shard, by the counts of all items or else of its own; None if no item has a word."""
    hashed = [(i, text, words) for (i, text), words in zip(items, _hashes([t for _, t in items]), strict=True) if len(words)]
    if not hashed:
        return None
    runs: dict[int, dict[int, list[int]]] = {}
    for i, _, words in hashed:
        if len(words) < SHINGLE:
            runs.setdefault(len(words), {}).setdefault(int(_run(words)), []).append(i)
    hashed = [h for h in hashed if len(h[2]) >= SHINGLE]
    if not hashed:
        none = np.zeros(0, np.uint64)
        return Index([], [], [], runs, run_words, none, np.zeros(1 << 18, bool), np.zeros((0, 0)), [], 1)
    whole: list[tuple[int, np.ndarray]] = []
    apart: list[tuple[int, np.ndarray]] = []
    shingles, sides = [], []
    for number, (_, text, words) in enumerate(hashed):
        whole += [(number, p) for p in _parts(words)]
        answer = min(answer_words(text), len(words))
        split = 0 < answer < len(words)
        side = (words[:-answer], words[-answer:]) if split else (words, words[:0])
        shingles.append((_shingles(words), *(_shingles(x) if len(x) >= SHINGLE else x[:0] for x in side)))
        sides.append(side)
        if split:
            # a question of few words is in many texts
            apart += [(number, p) for p in _parts(side[0] if len(side[0]) >= SHINGLE else max(side, key=len))]
    vocabulary = np.unique(np.concatenate([p for _, p in whole]))
    counts = counts or part_counts([text for _, text, _ in hashed])
    in_parts = counts.in_parts[np.searchsorted(counts.vocabulary, vocabulary)]
    rarity = np.log1p((counts.parts - in_parts + 0.5) / (in_parts + 0.5))
    average = counts.words / counts.parts
    parts = sorted(whole + apart, key=lambda p: len(p[1]))
    codes = [np.searchsorted(vocabulary, p) for _, p in parts]
    found = [np.unique(c, return_counts=True) for c in codes]
    n_blocks = -(-len(parts) // BLOCK)
    block_most = np.zeros((len(vocabulary), n_blocks))
    blocks = []
    for b in range(n_blocks):
        own = range(b * BLOCK, min(len(parts), (b + 1) * BLOCK))
        words = np.unique(np.concatenate([found[p][0] for p in own]))
        weights = np.zeros((len(words) + 1, len(own)))
        for column, p in enumerate(own):
            at, times = found[p]
            length = K1 * (1 - B + B * len(codes[p]) / average)
            raw = rarity[at] * times * (K1 + 1) / (times + length)
            weights[np.searchsorted(words, at), column] = raw / raw.sum()
        block_most[words, b] = weights[:-1].max(axis=1)
        row = np.full(len(vocabulary), len(words), np.int32)
        row[words] = np.arange(len(words))
        blocks.append((row, weights, np.array([parts[p][0] for p in own])))
    maybe = np.zeros(1 << 18, bool)
    maybe[vocabulary & np.uint64((1 << 18) - 1)] = True
    longest = max(len(p) for _, p in parts)
    ids = [i for i, _, _ in hashed]
    return Index(ids, shingles, sides, runs, run_words, vocabulary, maybe, block_most, blocks, -(-longest // SEGMENT) + 1)


def _retrieve(index: Index, words: np.ndarray, first: np.ndarray) -> dict[int, dict[int, float]]:
    """row -> item number -> best score, of all passages and items that reach the threshold."""
    if not index.blocks:
        return {}
    at = np.flatnonzero(index.maybe[words & np.uint64((1 << 18) - 1)])
    code = np.searchsorted(index.vocabulary, words[at])
    code[code == len(index.vocabulary)] = 0
    known = index.vocabulary[code] == words[at]
    at, code = at[known], code[known]
    if not len(at):
        return {}
    counts = np.diff(first)
    rows = np.searchsorted(first, at, "right") - 1
    # segments in a line, with empty ones between rows, so that no passage reaches into the next row
    base = np.concatenate([[0], np.cumsum(-(-counts // SEGMENT) + index.passage)])
    segment = base[rows] + (at - first[rows]) // SEGMENT
    # the segment of the same word before, as far back as a passage reaches
    order = np.argsort(code.astype(np.uint16) if len(index.vocabulary) < 1 << 16 else code, kind="stable")
    before = np.full(len(code), -1)
    same = code[order[1:]] == code[order[:-1]]
    before[order[1:][same]] = segment[order[:-1][same]]
    # a word adds to the passages from ``start`` to its own segment
    start = np.maximum(np.maximum(segment - index.passage + 1, before + 1), base[rows])
    adds = np.flatnonzero(start <= segment)
    change = np.zeros((base[-1] + 1, index.block_most.shape[1]))
    for sign, where in ((1, start[adds]), (-1, segment[adds] + 1)):
        order = np.argsort(where, kind="stable")
        cuts = np.flatnonzero(np.diff(where[order], prepend=-1))
        change[where[order][cuts]] += sign * np.add.reduceat(index.block_most[code[adds[order]]], cuts, axis=0)
    np.cumsum(change, axis=0, out=change)
    begin = np.searchsorted(segment, np.arange(base[-1] + index.passage + 1))
    out: dict[int, dict[int, float]] = {}
    for s, b in np.argwhere(change >= SCORE - 1e-9):
        inside = slice(begin[s], begin[s + index.passage])
        row_of, weights, of_part = index.blocks[b]
        found = weights[row_of[code[inside][before[inside] < s]]].sum(axis=0)
        if found.max() >= SCORE:
            row = int(np.searchsorted(base, s, "right")) - 1
            best = out.setdefault(row, {})
            for p in np.flatnonzero(found >= SCORE):
                best[int(of_part[p])] = max(best.get(int(of_part[p]), 0.0), float(found[p]))
    return out


def _share(of: np.ndarray, there: np.ndarray) -> float | None:
    return float(np.isin(of, there, assume_unique=True).mean()) if len(of) else None


def _runs(index: Index, words: np.ndarray, first: np.ndarray) -> set[tuple[int, int]]:
    """(row, item id) of the items shorter than a shingle."""
    out = set()
    for k, wanted in index.runs.items():
        found, at = shingle_hashes(words, first, k)
        here = np.flatnonzero(np.isin(found, np.fromiter(wanted, np.uint64)))
        rows = np.searchsorted(at, here, "right") - 1
        if k < index.run_words:
            alone = np.diff(first)[rows] == k
            here, rows = here[alone], rows[alone]
        out |= {(row, i) for row, run in set(zip(rows.tolist(), found[here].tolist(), strict=True)) for i in wanted[run]}
    return out


def _side_share(of: np.ndarray, side: np.ndarray, words: np.ndarray, there: np.ndarray) -> float | None:
    """Share of the shingles of a question or answer; of fewer words, whether they occur in a run."""
    if 0 < len(side) < SHINGLE:
        return float(_run(side) in shingle_hashes(words, np.array([0, len(words)]), len(side))[0])
    return _share(of, there)


def _verified(index: Index, number: int, score: float, words: np.ndarray, there: np.ndarray) -> dict | None:
    """The hit of a retrieved item in a text of these words and shingles; None if too little of the item is there."""
    shingles, sides = index.shingles[number], index.sides[number]
    whole = _share(shingles[0], there)
    question, answer = (_side_share(x, side, words, there) for x, side in zip(shingles[1:], sides, strict=True))
    both = answer is not None and min(question, answer) >= OVERLAP
    if not (whole >= OVERLAP or both or (question == 1 and len(sides[0]) >= QUESTION_WORDS)):
        return None
    return {"item_id": index.item_ids[number], "bm25": score, "overlap": whole, "question_overlap": question, "answer_overlap": answer}


def find_hits(index: Index, column: pa.Array) -> list[list[dict]]:
    """For each text the items that are retrieved and verified."""
    out: list[list[dict]] = []
    for _, data, offsets in chunks(column):
        words, first = word_hashes(data, offsets)
        hits: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
        for row, items in _retrieve(index, words, first).items():
            own = words[first[row] : first[row + 1]]
            there = _shingles(own)
            found = (_verified(index, number, score, own, there) for number, score in sorted(items.items()))
            hits[row] += [h for h in found if h]
        for row, item in sorted(_runs(index, words, first)):
            hits[row].append({"item_id": item, "bm25": 1.0, "overlap": 1.0, "question_overlap": None, "answer_overlap": None})
        out += hits
    return out


def _shards(items: DataFrame) -> Iterator[tuple[list[tuple[int, str]], Counts | None]]:
    """The items in shards of bounded size, by digest, and if there are several the counts of all items for each one's words.

    One shard at a time is on the driver.
    """
    rows, chars = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    if rows <= SHARD_ITEMS and chars <= SHARD_CHARS:
        yield sorted((r.item_id, r.text) for r in items.collect()), None
        return
    # twice as many as would do on average, as digests do not deal evenly
    n = 2 * max(-(-rows // SHARD_ITEMS), -(-chars // SHARD_CHARS))
    sums = items.select("text").mapInArrow(_sum_counts, "what string, word long, n long")
    sums = stored(sums.groupBy("what", "word").agg(F.sum("n").alias("n")), "item_words")
    total = {r.what: r.n for r in sums.filter("what != 'word'").collect()}
    for i in range(n):
        found = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
        shard = sorted((r.item_id, r.text) for r in found)
        words = signed(part_counts([text for _, text in shard]).vocabulary).tolist()
        own = items.sparkSession.createDataFrame([(w,) for w in words], "word long")
        known = {r.word: r.n for r in sums.filter("what = 'word'").join(own, "word", "left_semi").collect()}
        order = sorted(known, key=lambda w: w % (1 << 64))
        vocabulary = np.array(order, np.int64).view(np.uint64)
        yield shard, Counts(total.get("parts", 0), total.get("words", 0), vocabulary, np.array([known[w] for w in order], np.int64))
    discard(sums)


def with_hits(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    name: str = "hits",
    *,
    item_id: str = "item_id",
    item_text: str = "text",
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """The documents with all their columns and an array of the benchmark items they contain.

    An item is contained when one of its parts, or of its question's, scores at least ``SCORE`` against a passage and the text
    holds ``OVERLAP`` of the item's five-word shingles, or ``OVERLAP`` of the question's and of the answer's (the last
    sentence) each, or the whole question if that has ``QUESTION_WORDS`` words. An answer alone does not count.
    A question or answer of fewer than five words is there, 1 or 0, as a run of its words. So is an item of fewer than five
    words, from ``run_words`` words on; a shorter one is contained only in a text that is those words.
    ``answer_overlap`` is NULL where there is only one sentence, both are for items of fewer than five words. Items with a
    NULL id, NULL text or no word match nothing, nor do NULL or empty texts. Repeated rows each get their hits.
    A ``name`` that is a column already is refused.
    """
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the documents already have a column {name}; choose another name")
    at = docs.columns.index(text_col)
    items = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    items = items.dropna().distinct()
    spark, out = docs.sparkSession, docs.withColumn(name, F.array().cast(T.ArrayType(HIT)))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(HIT))])
    kind = pa.list_(pa.struct([("item_id", pa.int64()), *[(f.name, pa.float64()) for f in HIT.fields[1:]]]))
    for shard, counts in _shards(items):
        index = build_index(shard, run_words, counts)
        if index is None:
            continue
        shared = spark.sparkContext.broadcast(index)

        def apply(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                new = find_hits(shared.value, batch.column(at))
                old = batch.column(batch.num_columns - 1).to_pylist()
                hits = pa.array([a + b for a, b in zip(old, new, strict=True)], kind)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], hits], batch.schema.names)

        out = out.mapInArrow(apply, schema)
    return out


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, with their columns, that contain no benchmark item."""
    name = unused(docs, "hits")
    return with_hits(docs, items, text_col, name).filter(F.size(name) == 0).drop(name)
