"""Removal of repeated byte strings of 100 bytes and more, across and inside documents, with suffix arrays.

Only texts that may repeat are sorted. Each 100-byte window has an anchor: the leftmost of its 32-byte strings with the
least hash. Neighbouring windows with one anchor make a fragment; equal windows have equal anchors at the same distance, so
only fragments with one anchor hash can share windows. Hashes of fragments meet by their anchor hash; an anchor that occurs
once ends there. Of fragments with equal text the first stays and all others are known to repeat it (of one slice of
documents before anything is shuffled).

The texts of fragments whose anchor has several different ones are fetched and suffix-sorted, slice by slice of whole anchors, in two
stages: suffixes smaller than their successors are sorted directly, all others are induced from their successors in
one scan over the buckets of first bytes. Neighbours with a common prefix of 100 bytes are equal windows; all but the first
of them go.

An anchor with very many different texts around it is not sorted: its windows are told by digests, counted before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.words import _BASE, _INVERSE, _power, chunks, mix, signed
from tarmac.session import discard, stored

LENGTH = 100
ANCHOR = 32
_SPAN = LENGTH - ANCHOR + 1
#: Different texts around one anchor from which on its windows are told by digests.
HOT_ANCHOR = 4096
#: Bytes of fragments that are sorted at once, and a little more: anchors are not split.
SORTED_BYTES = 2 << 20
LEAST_ID = -(1 << 63)
#: Bits of a place: version of the text, start byte, windows, whether the fragment repeats in its slice, whether it is a copy.
VERSION_BITS, START_BITS, WINDOW_BITS = 22, 31, 7
_START_AT = WINDOW_BITS + 2
_VERSION_AT = _START_AT + START_BITS

_BYTE = np.random.Generator(np.random.PCG64(13)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

OCCURRENCES = "h long, c long, doc_id long, place long"
FRAGMENTS = "h long, doc_id long, place long, content binary"
SPANS = "doc_id long, version long, start long, end long"
KEPT = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, start (in its row), windows, anchor hash and text hash of all fragments of the rows' bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=sums[1:])
    inverse = _power(_INVERSE, len(data) + 1)
    counts = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    if not counts.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    least = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * inverse[: len(data) + 1 - ANCHOR])
    grams = least
    at = np.arange(len(least), dtype=np.int32)
    width = 1

    def joined(shift: int, n: int) -> None:
        nonlocal least, at
        right, right_at = least[shift : shift + n], at[shift : shift + n]
        smaller = right < least[:n]
        at = np.where(smaller, right_at, at[:n])
        least = np.where(smaller, right, least[:n])

    while 2 * width <= _SPAN:
        joined(width, len(least) - width)
        width *= 2
    if width < _SPAN:
        joined(_SPAN - width, len(least) - (_SPAN - width))
    row_of = np.repeat(np.arange(len(counts)), counts)
    window = np.arange(len(row_of)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[:-1][row_of]
    anchor = at[window]
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (row_of[1:] != row_of[:-1])))
    n = np.diff(np.append(new, len(window)))
    start = window[new]
    end = start + n + LENGTH - 1
    content = mix((sums[end] - sums[start]) * inverse[start] + n.astype(np.uint64))
    return row_of[new], start - offsets[row_of[new]], n, grams[anchor[new]], content


def occurrence_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, version, text) -> fragments: anchor hash, text hash, id, place.

    Of equal fragments of a slice the first is marked to repeat; the others are marked as copies and get an anchor
    hash of their own, since nothing needs to be found out about them.
    """
    for batch in batches:
        doc_ids, versions = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for first, data, offsets in chunks(batch.column(2)):
            row, start, n, h, c = anchors(data, offsets)
            if not len(row):
                continue
            doc = doc_ids[first + row]
            place = (versions[first + row] << _VERSION_AT) | (start << _START_AT) | (n << 2)
            order = np.lexsort((place, doc, c, h))
            doc, place, h, c = doc[order], place[order], h[order], c[order]
            new = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]))
            head = np.flatnonzero(new)
            of = head[np.cumsum(new) - 1]
            later = (doc != doc[of]) | (place != place[of])
            repeats = np.zeros(len(h), bool)
            repeats[of[later]] = True
            place |= (repeats.astype(np.int64) << 1) | later
            h[later] = mix(h[later] + place[later].astype(np.uint64) + mix(doc[later].astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(h)), pa.array(signed(c)), pa.array(doc), pa.array(place)], ["h", "c", "doc_id", "place"]
            )


def content_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, [(h, place)]) -> h, id, place and the bytes of each fragment."""
    for batch in batches:
        texts, wanted = batch.column(1).cast(pa.large_string()), batch.column(2)
        counts = wanted.value_lengths().to_numpy()
        fields = wanted.flatten()
        h, place = fields.field("h"), fields.field("place").to_numpy()
        text_at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        row = np.repeat(np.arange(len(counts)), counts)
        begin = text_at[row] + ((place >> _START_AT) & ((1 << START_BITS) - 1))
        size = ((place >> 2) & ((1 << WINDOW_BITS) - 1)) + LENGTH - 1
        doc = batch.column(0).to_numpy()[row]
        for i in range(0, len(row), 20_000):
            part = slice(i, i + 20_000)
            ends = np.cumsum(size[part])
            inner = np.arange(ends[-1]) - np.repeat(ends - size[part], size[part])
            content = data[np.repeat(begin[part], size[part]) + inner]
            at = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    h.slice(i, 20_000),
                    pa.array(doc[part]),
                    pa.array(place[part]),
                    pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(content)]),
                ],
                ["h", "doc_id", "place", "content"],
            )


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, the first byte highest."""
    padded = np.concatenate([text, np.zeros(LENGTH + 16, np.uint8)])
    words = np.zeros(len(padded) - 8, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k : len(padded) - 8 + k]
    return words


_LAST = (LENGTH - 1) // 8
_CUT = np.uint64(64 - 8 * (LENGTH - 8 * _LAST))


def _word(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    out = words[at + 8 * k]
    return out >> _CUT if k == _LAST else out


def sort_directly(words: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """The suffixes by their first 100 bytes: eight bytes, then the next eight of those that agree, and so on."""
    if not len(suffixes):
        return suffixes
    key = _word(words, suffixes, 0)
    order = np.argsort(key, kind="stable")
    out, key = suffixes[order], key[order]
    group = np.cumsum(np.append(False, key[1:] != key[:-1]))
    tied = np.arange(len(out))
    for k in range(1, _LAST + 1):
        size = np.bincount(group)
        several = size[group] > 1
        tied, group = tied[several], group[several]
        if not len(tied):
            break
        key = _word(words, out[tied], k)
        order = np.lexsort((key, group))
        out[tied] = out[tied][order]
        key, group = key[order], group[order]
        group = np.cumsum(np.append(False, (key[1:] != key[:-1]) | (group[1:] != group[:-1])))
    return out


def suffix_array(text: np.ndarray, first: np.ndarray, windows: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Starts of all windows of fragments, sorted by their 100 bytes, in two stages.

    ``text`` holds the fragments' bytes plus one, each followed by 0; a fragment from ``first`` on has ``windows`` windows.
    """
    n = len(text)
    # smaller than the successor: the next other byte is larger
    change = np.append(text[1:] != text[:-1], True)
    next_change = np.where(change, np.arange(n), n - 1)
    next_change = np.minimum.accumulate(next_change[::-1])[::-1]
    following = np.append(text[1:], np.uint8(0))[next_change]
    rises = (following > text) & (text > 0)
    # a fragment's windows, and what follows up to the next rising suffix or its end
    anchored = np.where(rises | (text == 0), np.arange(n), n - 1)
    next_anchor = np.minimum.accumulate(anchored[::-1])[::-1]
    border = next_anchor[first + windows - 1]
    depth = np.zeros(n + 1, np.int32)
    depth[first] += 1
    depth[border + 1] -= 1
    wanted = np.cumsum(depth[:-1]) > 0
    induced = wanted & ~rises & (text > 0)

    direct = sort_directly(words, np.flatnonzero(wanted & rises))
    bounds = np.searchsorted(text[direct], np.arange(257))
    buckets: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []

    def scan(suffixes: np.ndarray, byte: int) -> np.ndarray:
        """Put the predecessors that are to be induced into their buckets; those of the same bucket are returned."""
        before = suffixes[suffixes > 0] - 1
        before = before[induced[before]]
        of = text[before]
        same = before[of == byte]
        before, of = before[of > byte], of[of > byte]
        order = np.argsort(of, kind="stable")
        before, of = before[order], of[order]
        cuts = [*np.flatnonzero(np.append(True, of[1:] != of[:-1])).tolist(), len(of)] if len(of) else []
        for a, b in zip(cuts, cuts[1:], strict=False):
            buckets[int(of[a])].append(before[a:b])
        return same

    scan(np.flatnonzero(wanted & (text == 0)), 0)
    for byte in range(1, 257):
        current = np.concatenate(buckets[byte]) if buckets[byte] else direct[:0]
        while len(current):
            out.append(current)
            current = scan(current, byte)
        own = direct[bounds[byte] : bounds[byte + 1]] if byte < 256 else direct[:0]
        if len(own):
            out.append(own)
            scan(own, byte)
    sorted_ = np.concatenate(out) if out else direct
    is_window = np.zeros(n + 1, np.int32)
    is_window[first] += 1
    is_window[first + windows] -= 1
    return sorted_[np.cumsum(is_window[:-1])[sorted_] > 0]


def common_prefixes(words: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Bytes, 100 at most, that each suffix shares with the one before it."""
    shared = np.full(len(suffixes), LENGTH, np.int64)
    if not len(shared):
        return shared
    shared[0] = 0
    open_ = np.arange(1, len(suffixes))
    for k in range(_LAST + 1):
        x = _word(words, suffixes[open_], k) ^ _word(words, suffixes[open_ - 1], k)
        differ = x != 0
        d = x[differ]
        n_bytes = LENGTH - 8 * k if k == _LAST else 8
        equal = sum((d >> np.uint64(8 * (n_bytes - 1 - j)) == 0).astype(np.int64) for j in range(n_bytes))
        shared[open_[differ]] = 8 * k + equal
        open_ = open_[~differ]
    return shared


def repeated_spans(data: np.ndarray, sizes: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Id, place of the first window and number of windows of all stretches of windows that occur at an earlier place."""
    n = len(sizes)
    # a byte more after each fragment
    first = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.zeros(int((sizes + 1).sum()), np.uint8)
    text[np.arange(len(data)) + np.repeat(np.arange(n), sizes)] = data + np.uint8(1)
    words = _words(text)
    suffixes = suffix_array(text, first, sizes - LENGTH + 1, words)
    group = np.cumsum(common_prefixes(words, suffixes) < LENGTH)
    fragment = np.searchsorted(first, suffixes, "right") - 1
    window_place = (place[fragment] >> _START_AT) + (suffixes - first[fragment])
    order = np.lexsort((window_place, doc[fragment], group))
    suffixes, group, fragment, window_place = suffixes[order], group[order], fragment[order], window_place[order]
    head = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    of = head[np.cumsum(np.append(True, group[1:] != group[:-1])) - 1] if len(group) else head
    later = (doc[fragment] != doc[fragment[of]]) | (window_place != window_place[of])
    suffixes, fragment, window_place = suffixes[later], fragment[later], window_place[later]
    order = np.argsort(suffixes, kind="stable")
    suffixes, fragment, window_place = suffixes[order], fragment[order], window_place[order]
    if not len(suffixes):
        return doc[:0], place[:0], place[:0]
    starts = np.flatnonzero(np.append(True, (suffixes[1:] != suffixes[:-1] + 1) | (fragment[1:] != fragment[:-1])))
    return doc[fragment[starts]], window_place[starts], np.diff(np.append(starts, len(suffixes)))


def _spans(doc: np.ndarray, window_place: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    start = window_place & ((1 << START_BITS) - 1)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(window_place >> START_BITS), pa.array(start), pa.array(start + n + LENGTH - 1)],
        ["doc_id", "version", "start", "end"],
    )


def sort_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments sorted by anchor hash -> spans that occur at an earlier place, by slices of whole anchors."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < SORTED_BYTES:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        h = table.column(0).to_numpy()
        cut = int(np.searchsorted(np.append(False, h[1:] != h[:-1]).cumsum(), (np.append(False, h[1:] != h[:-1]).sum())))
        if not cut:
            continue
        yield from _sorted(table.slice(0, cut))
        rest = table.slice(cut).combine_chunks()
        held, size = rest.to_batches(), rest.nbytes
    if held:
        yield from _sorted(pa.Table.from_batches(held).combine_chunks())


def _sorted(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if not len(table):
        return
    content = table.column(3).combine_chunks().cast(pa.large_binary())
    at = np.frombuffer(content.buffers()[1], np.int64)[content.offset : content.offset + len(content) + 1]
    data = np.frombuffer(content.buffers()[2], np.uint8)[at[0] : at[-1]]
    h = table.column(0).to_numpy()
    edges = np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h))
    begin = 0
    # pieces of whole anchors, for batches much larger than a slice
    while begin < len(edges) - 1:
        limit = at[edges[begin]] + SORTED_BYTES
        end = max(begin + 1, int(np.searchsorted(at[edges], limit, "right")) - 1)
        a, b = int(edges[begin]), int(edges[end])
        part = data[at[a] - at[0] : at[b] - at[0]]
        yield _spans(*repeated_spans(part, np.diff(at[a : b + 1]), table.column(1).to_numpy()[a:b], table.column(2).to_numpy()[a:b]))
        begin = end


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) -> id, number of bytes, merged spans, bytes that remain."""
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for i in range(0, batch.num_rows, 1000):
            part = batch.slice(i, 1000)
            rows, merged = [], []
            for text, found in zip(texts.slice(i, 1000).to_pylist(), part.column(2).to_pylist(), strict=True):
                text, spans, at, kept = text or b"", [], 0, []
                for span in sorted((s["start"], s["end"]) for s in found or ()):
                    if spans and span[0] <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], span[1])
                    else:
                        spans.append({"start": span[0], "end": span[1]})
                for span in spans:
                    kept.append(text[at : span["start"]])
                    at = span["end"]
                rows.append((len(text), b"".join([*kept, text[at:]])))
                merged.append(spans)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([n for n, _ in rows], pa.int64()),
                    pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([kept for _, kept in rows], pa.binary()),
                ],
                ["doc_id", "n_bytes", "spans", "kept"],
            )


def _hot_spans(fragments: DataFrame) -> DataFrame:
    """Spans of windows that occur at an earlier place, from the texts of fragments: by digests of single windows."""
    windows = F.shiftright("place", 2).bitwiseAND((1 << WINDOW_BITS) - 1)
    single = fragments.select("doc_id", F.shiftright("place", _START_AT).alias("from"), "content", F.explode(F.sequence(F.lit(0), (windows - 1).cast("int"))).alias("i"))
    digest: Column = F.unhex(F.md5(F.substring("content", F.col("i") + 1, F.lit(LENGTH))))
    single = single.select("doc_id", (F.col("from") + F.col("i")).alias("place"), digest.alias("digest"))
    firsts = single.groupBy("digest").agg(F.min(F.struct("doc_id", "place")).alias("first"))
    later = single.join(firsts, "digest").filter(F.struct("doc_id", "place") > F.col("first"))
    start = F.col("place").bitwiseAND((1 << START_BITS) - 1)
    return later.select("doc_id", F.shiftright("place", START_BITS).alias("version"), start.alias("start"), (start + LENGTH).alias("end"))


def drop_repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (start, end), kept (the bytes outside the spans).

    A byte goes if a string of 100 bytes covers it that also starts earlier: in a document with a smaller id, or further
    ahead in its own; the two may overlap. Strings are judged on the texts as given, not on what is left of them. ``spans`` are
    the maximal runs of bytes that go. Cuts may fall inside a character, so ``kept`` is binary.

    Texts are UTF-8 bytes; NULL is empty. Texts under 100 bytes stay whole. NULL ids come first. Rows that agree in id and text
    are one document and do not remove each other; rows with one id and other texts are ordered by a 22-bit
    digest of the text. Fragments are told apart by 128 bits of hashes. Without rows the result is empty; other
    columns are not looked at. A text of 2 GB or more is refused by Arrow.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    version = F.xxhash64(text).bitwiseAND((1 << VERSION_BITS) - 1)
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID)).alias("doc_id"), version.alias("version"), text.alias("text"))

    same, equal = Window.partitionBy("h"), Window.partitionBy("h", "c")
    is_copy = F.col("place").bitwiseAND(1) == 1
    marked = F.col("place").bitwiseAND(2) == 2
    found = base.mapInArrow(occurrence_batches, OCCURRENCES).withColumn("n", F.count(F.lit(1)).over(same))
    found = found.filter((F.col("n") > 1) | is_copy | marked)
    unmarked = F.struct("doc_id", F.shiftright("place", 2).alias("at"))
    found = found.withColumn("later", is_copy | (unmarked > F.min(unmarked).over(equal)))
    # different texts of an anchor: firsts of equal ones, that a copied row may show twice
    found = found.withColumn("n_texts", F.count(F.when(~F.col("later"), 1)).over(same))
    found = stored(found.select("h", "doc_id", "place", "later", "n_texts"), "found")

    start = F.shiftright("place", _START_AT).bitwiseAND((1 << START_BITS) - 1)
    size = F.shiftright("place", 2).bitwiseAND((1 << WINDOW_BITS) - 1) + LENGTH - 1
    own_version = F.shiftright("place", _VERSION_AT).alias("version")
    copies = found.filter("later").select("doc_id", own_version, start.alias("start"), (start + size).alias("end"))

    def fragments(rows: DataFrame) -> DataFrame:
        wanted = rows.groupBy("doc_id", own_version).agg(F.collect_set(F.struct("h", "place")).alias("wanted"))
        return base.join(wanted, ["doc_id", "version"]).select("doc_id", "text", "wanted").mapInArrow(content_batches, FRAGMENTS)

    several = found.filter(f"NOT later AND n_texts BETWEEN 2 AND {HOT_ANCHOR}")
    by_anchor = fragments(several).repartition("h").sortWithinPartitions("h")
    spans = copies.unionByName(by_anchor.mapInArrow(sort_batches, SPANS))
    hot = found.filter(f"NOT later AND n_texts > {HOT_ANCHOR}")
    if not hot.isEmpty():
        spans = spans.unionByName(_hot_spans(fragments(hot)))
    of_text = spans.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    out = base.join(of_text, ["doc_id", "version"], "left").select("doc_id", "text", "spans").mapInArrow(cut_batches, KEPT)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != LEAST_ID, F.col("doc_id")))
