"""Runs of repeated word sequences inside documents, found with a grammar made by recompression.

The words of a slice of documents become symbols (equal words, equal symbols) with a symbol of its own after each
document. Then two steps alternate until every document is one symbol. *Blocks*: each stretch of one repeated symbol
becomes a symbol for (symbol, times). *Pairs*: symbols are dealt into a left and a right half by a digest, and each left
symbol that a right one follows becomes a symbol with it. Equal symbols always stand for equal words, so the levels are
a run-length grammar of the slice.

The common extension of two places climbs that grammar while their symbols agree and descends where they differ,
with at most one step (or one block) on each level; all questions of a slice are answered together with numpy.

A run of period q holds at least 3q places whose word equals the one q further on, or 5 where q is 1. So for every
q the places 0, 3q, 6q, ... of a document are asked, a harmonic grid of n log n places. Where both words agree, the exact
extensions to both sides give the run. A stretch found with several periods has the least of them. No suffix array is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.words import chunks, word_bounds

#: A run repeats at least this often and has at least this many words.
LEAST_TIMES = 4
LEAST_WORDS = 6
#: Bytes of text that share a grammar; a longer document has one of its own.
SLICE_BYTES = 1 << 20
#: Candidate places that are asked at once.
ASKED_AT_ONCE = 1 << 19

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def mix32(x: np.ndarray, level: int) -> np.ndarray:
    """A fixed scrambling of symbols, another one for every level."""
    x = (x.astype(np.uint64) + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Grammar:
    """Levels of a recompression of ``symbols``; those from ``fixed`` on (one after each document) stay as they are.

    ``symbols[l]`` are the symbols of a level, ``lengths[l]`` their numbers of words, ``parents[l]`` the place on
    the next level that holds each, ``firsts[l]`` the first place on the level below (one more at the end).
    ``blocks[l]`` tells whether level l + 1 was made by blocks.
    """

    def __init__(self, symbols: np.ndarray, n_words: int, n_documents: int):
        # 0 .. n_words - 1 are words, the next n_documents are ends of documents, later numbers are made here
        self.low, self.high = n_words, n_words + n_documents
        self.next = self.high
        self.symbols = [symbols.astype(np.int64)]
        self.lengths = [np.ones(len(symbols), np.int64)]
        self.parents: list[np.ndarray] = []
        self.firsts: list[np.ndarray] = []
        self.blocks: list[bool] = []
        while len(self.symbols[-1]) > 2 * n_documents:
            self._add(self._blocks(), True)
            if len(self.symbols[-1]) <= 2 * n_documents:
                break
            self._add(self._pairs(), False)

    def _add(self, made: tuple[np.ndarray, np.ndarray] | None, blocks: bool) -> None:
        """A level from the first places of its symbols and the symbols; without one where nothing changed."""
        if made is None:
            return
        first, symbols = made
        below = len(self.symbols[-1])
        is_first = np.zeros(below, np.int64)
        is_first[first] = 1
        self.parents.append(np.cumsum(is_first) - 1)
        self.firsts.append(np.append(first, below))
        self.lengths.append(np.add.reduceat(self.lengths[-1], first))
        self.symbols.append(symbols)
        self.blocks.append(blocks)

    def _named(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """New symbols for pairs of numbers, equal for equal pairs."""
        _, name = np.unique(left * np.int64(max(self.next, int(right.max()) + 1)) + right, return_inverse=True)
        symbols = name + self.next
        self.next += int(name.max()) + 1
        return symbols

    def _blocks(self) -> tuple[np.ndarray, np.ndarray] | None:
        s = self.symbols[-1]
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        times = np.diff(np.append(first, len(s)))
        long = times > 1
        if not long.any():
            return None
        out = s[first]
        out[long] = self._named(out[long], times[long])
        return first, out

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        s, level = self.symbols[-1], len(self.symbols)
        inner = (s < self.low) | (s >= self.high)
        side = (mix32(s, level) >> np.uint64(63)).astype(bool)
        both = inner[:-1] & inner[1:] & (side[:-1] != side[1:])
        lead = side[:-1] & both
        # of the two ways round, the one that joins more
        if 2 * np.count_nonzero(lead) < np.count_nonzero(both):
            lead = both & ~lead
        at = np.flatnonzero(lead)
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        out = s.copy()
        if len(at):
            out[at] = self._named(s[at], s[at + 1])
        return np.flatnonzero(keep), out[keep]

    def extension(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words agree from places i and j (of one document, i < j) on; ``back``: before them."""
        total = np.zeros(len(i), np.int64)
        p, q = (i - 1, j - 1) if back else (i.copy(), j.copy())
        level_of = np.zeros(len(i), np.int64)
        active = np.arange(len(i))
        top = len(self.symbols) - 1
        for level in range(top + 1):
            # up: agree on this level until both stand at an edge of their parents
            a, b = p[active], q[active]
            if level < top:
                a, b, gained = self._step(level, a, b, back, False)
            else:
                a, b, gained = self._walk(level, a, b, back)
            total[active] += gained
            p[active], q[active] = a, b
            level_of[active] = level
            if level == top:
                break
            inside = (a >= 0) & (b >= 0)
            up = np.zeros(len(a), bool)
            x, y = a[inside], b[inside]
            up[inside] = (self.symbols[level][x] == self.symbols[level][y]) & self._at_edge(level, x, back) & self._at_edge(level, y, back)
            active = active[up]
            if not len(active):
                break
            p[active], q[active] = self.parents[level][a[up]], self.parents[level][b[up]]
        for level in range(int(level_of.max(initial=0)), 0, -1):
            # down: the symbols differ, so do the parts of one of them or what follows it
            down = np.flatnonzero((level_of >= level) & (p >= 0) & (q >= 0))
            first = self.firsts[level - 1]
            a, b = (first[p[down] + 1] - 1, first[q[down] + 1] - 1) if back else (first[p[down]], first[q[down]])
            a, b, gained = self._step(level - 1, a, b, back, True)
            p[down], q[down] = a, b
            total[down] += gained
        return total

    def _at_edge(self, level: int, at: np.ndarray, back: bool) -> np.ndarray:
        first, parent = self.firsts[level], self.parents[level][at]
        return at == (first[parent + 1] - 1 if back else first[parent])

    def _left(self, level: int, at: np.ndarray, back: bool) -> np.ndarray:
        """How many symbols of the parent lie from here on."""
        first, parent = self.firsts[level], self.parents[level][at]
        return at - first[parent] + 1 if back else first[parent + 1] - at

    def _step(self, level: int, a: np.ndarray, b: np.ndarray, back: bool, always: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Go on over what agrees inside the parents: one symbol, or a block. Places at the edges of both parents
        stay where they are (they can go up), unless ``always``."""
        s, lengths = self.symbols[level], self.lengths[level]
        gained = np.zeros(len(a), np.int64)
        ok = (a >= 0) & (b >= 0) & (a < len(s)) & (b < len(s))
        ok[ok] = s[a[ok]] == s[b[ok]]
        if not always:
            ok[ok] &= ~(self._at_edge(level, a[ok], back) & self._at_edge(level, b[ok], back))
        x, y = a[ok], b[ok]
        times = np.minimum(self._left(level, x, back), self._left(level, y, back)) if self.blocks[level] else np.ones(len(x), np.int64)
        gained[ok] = times * lengths[x]
        a, b = a.copy(), b.copy()
        a[ok] += -times if back else times
        b[ok] += -times if back else times
        return a, b, gained

    def _walk(self, level: int, a: np.ndarray, b: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """On the last level: symbol by symbol."""
        s, lengths = self.symbols[level], self.lengths[level]
        a, b, gained, move = a.copy(), b.copy(), np.zeros(len(a), np.int64), -1 if back else 1
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            ok = (x >= 0) & (y >= 0) & (x < len(s)) & (y < len(s))
            ok[ok] = s[x[ok]] == s[y[ok]]
            open_ = open_[ok]
            gained[open_] += lengths[a[open_]]
            a[open_] += move
            b[open_] += move
        return a, b, gained


def candidates(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, place, period) of the harmonic grids of documents with these numbers of words, in pieces."""
    most = int(counts.max(initial=0)) // LEAST_TIMES
    if counts.max(initial=0) < LEAST_WORDS:
        return
    order = np.argsort(-counts, kind="stable")
    sizes = counts[order]
    periods = np.arange(1, most + 1)
    steps = np.maximum(LEAST_WORDS, LEAST_TIMES * periods) - periods
    # documents long enough for a period come first in the order
    able = np.searchsorted(-sizes, -np.maximum(LEAST_TIMES * periods, LEAST_WORDS), "right")
    document = np.concatenate([order[:k] for k in able])
    period, step = np.repeat(periods, able), np.repeat(steps, able)
    asked = -(-(counts[document] - period) // step)
    ends = np.cumsum(asked)
    at = 0
    while at < len(asked):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ASKED_AT_ONCE, "right")))
        part = slice(at, end)
        n = asked[part]
        number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(document[part], n), number * np.repeat(step[part], n), np.repeat(period[part], n)
        at = end


def find_runs(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start, length and period of all runs, by document, start and period.

    ``symbols`` holds the words of all documents as numbers from 0, ``first`` the first of each (one more at the end).
    """
    none = np.zeros(0, np.int64)
    counts = np.diff(first)
    n_documents, n_words = len(counts), int(symbols.max(initial=-1)) + 1
    if not len(symbols) or counts.max() < LEAST_WORDS:
        return none, none, none, none
    # one symbol after each document, unlike all others
    spread = np.full(len(symbols) + n_documents, -1, np.int64)
    base = first[:-1] + np.arange(n_documents)
    spread[np.arange(len(symbols)) + np.repeat(np.arange(n_documents), counts)] = symbols
    spread[first[1:] + np.arange(n_documents)] = n_words + np.arange(n_documents)
    grammar = None
    found = []
    for document, place, period in candidates(counts):
        at = base[document] + place
        equal = spread[at] == spread[at + period]
        document, at, period = document[equal], at[equal], period[equal]
        if not len(at):
            continue
        grammar = grammar or Grammar(spread, n_words, n_documents)
        ahead = grammar.extension(at, at + period)
        behind = grammar.extension(at, at + period, back=True)
        length = ahead + behind + period
        long = length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
        found.append(np.stack([document, at - base[document] - behind, length, period])[:, long])
    if not found:
        return none, none, none, none
    document, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, document))
    document, start, length, period = (x[order] for x in (document, start, length, period))
    # the same stretch under several periods: its least one divides the others
    new = np.ones(len(order), bool)
    new[1:] = (document[1:] != document[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    document, start, length, period = (x[new] for x in (document, start, length, period))
    order = np.lexsort((period, start, document))
    return document[order], start[order], length[order], period[order]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """The words of each row joined by one space."""
    lengths = ends - starts + 1
    if len(lengths):
        # no space after the last word of a row
        last = first[1:][np.diff(first) > 0] - 1
        lengths[last] -= 1
    to = np.concatenate([[0], np.cumsum(lengths)])
    out = np.full(int(to[-1]), 0x20, np.uint8)
    n = ends - starts
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(to[:-1], n) + inside] = data[np.repeat(starts, n) + inside]
    return pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(to[first].astype(np.int64)), pa.py_buffer(out)])


def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> number of words, runs, and the text without the repeats."""
    for batch in batches:
        for row, data, offsets in chunks(batch.column(1), SLICE_BYTES):
            starts, ends, first = word_bounds(data, offsets)
            rows = len(offsets) - 1
            inside = np.zeros(len(data) + 1, np.int8)
            inside[starts] = 1
            inside[ends] -= 1
            letters = data[np.cumsum(inside[:-1]).astype(bool)]
            at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(letters))])
            symbols = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            document, start, length, period = find_runs(symbols, first)
            # words after a run's first period go
            begins, ends_of = (np.bincount(first[document] + start + x, minlength=len(symbols) + 1) for x in (period, length))
            kept = np.flatnonzero(np.cumsum(begins - ends_of)[:-1] == 0)
            runs = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(document, np.arange(rows + 1)), pa.int32()),
                pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"]),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(row, rows).cast(pa.int64()),
                    pa.array(np.diff(first), pa.int64()),
                    runs,
                    _joined(data, starts[kept], ends[kept], np.searchsorted(kept, first)).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period in words, by start and period), collapsed.

    A run is a stretch of consecutive words with least period q, at least max(6, 4q) long, that no neighbouring word
    extends keeping q. Words are runs of bytes other than 0x20 and 0x09-0x0D and are equal when their bytes are.
    ``collapsed`` is the text, its words joined by one space, without the words of any run that come after the
    run's first q.

    Rows stay apart: equal ids or texts are no special case, NULL ids stay NULL. A NULL, empty or
    wordless text has 0 words, no runs and an empty ``collapsed``; without rows the result is empty. Other columns are not looked
    at. Nothing is shuffled; memory of a task follows the slice of about 1 MB or the longest document, with some 300
    bytes a word.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run_batches, RUNS)
