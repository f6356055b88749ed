"""Token ids of documents in flat binary files with 64-bit document offsets.

A folder holds for each part of the sorted documents

* ``part-NNNNNN.bin``: the ids of its documents one after the other, little-endian unsigned integers of two
  bytes, or four where the vocabulary needs them;
* ``part-NNNNNN.idx``: little-endian 64-bit numbers: how many documents, the bytes of an id, the document ids,
  then the offset of each document in the part and the end of the last.

Parts follow each other in ascending document id. A part's place among all ids is the prefix sum of the sizes of
the parts before it, known once all are written. Files are written under another name and renamed, and a part's
content depends on its rows only, so a task that runs again leaves the same file.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.words import chunks

END_ID = 1
#: Words whose ids a worker remembers, about 250 bytes each; beyond it, it keeps the most used ones, which are most of the text.
REMEMBERED_WORDS = 300_000
KEPT_WORDS = 100_000
ENCODE_BYTES = 8 << 20
NULL_ID = -(1 << 63)
#: Ids that a task reads back at least, where there are more parts than cores.
READ_IDS = 4_000_000

#: Letters, and marks after them other than the apostrophe: the tokenizer splits these two and nothing else.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)\Z")


class WordEncoder:
    """Encodes text columns word by word, each distinct word once.

    Right for tokenizers that drop white space and never look across it. Rows that hold ``<|`` may hold
    special tokens and go to the tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        # how a byte is written in the vocabulary: printable ones as they are, others from U+0100 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in printable]
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.clear()

    def clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.used = 0
        self.uses = np.zeros(0, np.int64)

    def forget(self) -> None:
        """Keep the words that were used most."""
        order = np.argsort(-self.uses, kind="stable")[:KEPT_WORDS]
        words = list(self.slots)
        kept = [words[i] for i in order.tolist()]
        codes = [self.ids[self.ends[i] : self.ends[i + 1]].tolist() for i in order.tolist()]
        uses = self.uses[order]
        self.clear()
        self._remember(kept, codes)
        # what was used long ago counts less
        self.uses = uses // 2

    def _plain(self, word: str) -> list[int]:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(word)]

    def _learn(self, words: list[str]) -> None:
        codes: list[list[int] | None] = []
        pieces: dict[str, list[int]] = {"": []}
        others = []
        for word in words:
            parts = _PLAIN.match(word)
            if parts is None:
                others.append(len(codes))
                codes.append(None)
                continue
            stem, marks = parts.groups()
            code = pieces.get(stem)
            if code is None:
                code = pieces[stem] = self._plain(stem)
            if marks:
                tail = pieces.get(marks)
                if tail is None:
                    tail = pieces[marks] = self._plain(marks)
                code = code + tail
            codes.append(code)
        encoded = self.tokenizer.encode_batch([words[i] for i in others], add_special_tokens=False)
        for i, code in zip(others, encoded, strict=True):
            codes[i] = code.ids
        self._remember(words, codes)

    def _remember(self, words: list[str], codes: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, codes), np.int64, len(codes))
        total, known = int(lengths.sum()), len(self.slots)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while known + len(codes) + 2 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(codes), np.uint32, total)
        self.ends[known + 1 : known + 1 + len(codes)] = self.used + np.cumsum(lengths)
        self.used += total
        self.slots.update(zip(words, range(known, known + len(codes)), strict=True))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows one after the other, and how many each row has. NULL is empty."""
        if len(self.slots) > REMEMBERED_WORDS:
            self.forget()
        column = pc.fill_null(column, "")
        special = pc.match_substring(column, "<|").to_numpy(zero_copy_only=False)
        words = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(pa.array(~special), column, "")))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn([w for w in distinct if w not in self.slots])
        slot = np.fromiter((self.slots[w] for w in distinct), np.int64, len(distinct))
        slot = slot[coded.indices.to_numpy()] if len(distinct) else slot
        used = np.bincount(slot, minlength=len(self.slots))
        used[: len(self.uses)] += self.uses
        self.uses = used
        lengths = self.ends[slot + 1] - self.ends[slot]
        after = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.repeat(self.ends[slot] - after[:-1], lengths) + np.arange(after[-1])]
        bounds = words.offsets.to_numpy()
        per_row = after[bounds[1:]] - after[bounds[:-1]]
        if special.any():
            pieces = np.split(ids, np.cumsum(per_row)[:-1])
            for i in np.flatnonzero(special):
                pieces[i] = np.array(self.tokenizer.encode(column[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
                per_row[i] = len(pieces[i])
            ids = np.concatenate(pieces)
        return ids, per_row


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder a worker process and vocabulary, so that what it has learnt serves later tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _end_each(ids: np.ndarray, per_row: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' ids with the end id after each row, and where each row ends."""
    ends = np.cumsum(per_row + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(per_row)), per_row)] = ids
    return out, ends


def _file_system(place: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(place if "://" in place or place.startswith("file:") else f"file://{place}")


def _uri(place: str) -> str:
    """file:/x, as Spark prints paths, as file:///x."""
    return re.sub(r"^file:/+", "file:///", place)


def part_writer(place: str, tokenizer: str, end_id: int):
    """A function for mapInArrow: writes the partition's sorted (id, text) rows, returns one row about the part."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, (system, folder) = encoder(tokenizer), _file_system(place)
        part = TaskContext.get().partitionId()
        name, attempt = f"{folder}/part-{part:06d}", uuid.uuid4().hex
        out, doc_ids, ends, total = None, [], [np.zeros(1, np.int64)], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(f"{name}.bin.{attempt}")
            doc_ids.append(pc.fill_null(batch.column(0), NULL_ID).to_numpy())
            for first, _, offsets in chunks(batch.column(1), ENCODE_BYTES):
                rows = batch.column(1).slice(first, len(offsets) - 1)
                ids, row_ends = _end_each(*coder.encode(rows), end_id)
                out.write(ids.astype(f"<u{coder.width}").tobytes())
                ends.append(row_ends + total)
                total += len(ids)
        if out is None:
            return
        out.close()
        numbers = np.concatenate(doc_ids)
        with system.open_output_stream(f"{name}.idx.{attempt}") as index:
            index.write(struct.pack("<qq", len(numbers), coder.width))
            index.write(numbers.astype("<i8").tobytes())
            index.write(np.concatenate(ends).astype("<i8").tobytes())
        for kind in ("bin", "idx"):
            system.move(f"{name}.{kind}.{attempt}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int64()), "n_docs": pa.array([len(numbers)], pa.int64()), "n_ids": pa.array([total], pa.int64())}
        )

    return write


def write_token_files(
    docs: DataFrame, place: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> list[tuple[int, int, int]]:
    """Write all documents, in ascending id, to token files below ``place``; (part, documents, ids) of each part.

    ``place`` is a folder that all executors reach, on any file system that Arrow opens. ``end_id`` follows each
    document. A NULL text is empty; rows with one id all stay, ordered by text; a NULL id comes first and
    is written as the least 64-bit number. Without documents there are no files.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    parts = ordered.mapInArrow(part_writer(_uri(place), tokenizer, end_id), "part long, n_docs long, n_ids long")
    # one row per written file
    return sorted((r.part, r.n_docs, r.n_ids) for r in parts.collect())


def _read(system: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file as an array: mapped into memory where the file system allows it."""
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
    with system.open_input_file(path) as source:
        return np.frombuffer(source.read(), kind)


def read_part(system: fs.FileSystem, folder: str, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, offsets (one more than documents) and token ids of a part."""
    index = _read(system, f"{folder}/part-{part:06d}.idx", "<i8")
    n, width = int(index[0]), int(index[1])
    return index[2 : 2 + n], index[2 + n : 3 + 2 * n], _read(system, f"{folder}/part-{part:06d}.bin", f"<u{width}")


def read_token_files(spark: SparkSession, place: str, written: list[tuple[int, int, int]]) -> DataFrame:
    """One row per document in the files: doc_id, start among all ids, n_tokens, ids_crc32 (of 32-bit ids)."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not written:
        return spark.createDataFrame([], schema)
    numbers = [part for part, _, _ in written]
    bases = np.concatenate([[0], np.cumsum([n for _, _, n in written])])
    uri = _uri(place)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _file_system(uri)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                ids, offsets, tokens = read_part(system, folder, numbers[k])
                for i in range(0, len(ids), 10_000):
                    own = offsets[i : i + 10_001]
                    crc = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(own[:-1], own[1:], strict=True)]
                    doc_ids = ids[i : i + 10_000]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(doc_ids, pa.int64(), mask=doc_ids == NULL_ID),
                            "start": pa.array(own[:-1] + bases[k], pa.int64()),
                            "n_tokens": pa.array(np.diff(own), pa.int64()),
                            "ids_crc32": pa.array(crc, pa.int64()),
                        }
                    )

    # several small parts a task, one after the other
    tasks = min(len(numbers), max(spark.sparkContext.defaultParallelism, int(bases[-1]) // READ_IDS))
    return spark.range(0, len(numbers), 1, tasks).mapInArrow(read, schema)
