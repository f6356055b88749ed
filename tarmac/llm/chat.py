"""Chat formatting: turns of conversations as one text with marks, assembled as bytes of whole columns.

A turn is ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end. Control strings of this and other
common templates inside a text get a backslash after their first character, and one more if there are some
already; taking one away restores the text. After that no mark occurs in a text, so reading back is exact.

Turns are sorted by conversation. For each batch of turns the lengths of all pieces are known first; their sums
give each piece its place in one preallocated buffer, into which headers, texts and ends are copied by index.
The buffer is the Arrow column of formatted texts, its offsets are the places where conversations begin.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, BREAK, END = b"<|im_start|>", b"\n", b"<|im_end|>\n"
LOSS_ROLE = "assistant"
#: Control strings of common templates, without their first character: <| <s> </s> [INST] [/INST] <<SYS>> <</SYS>>.
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\]|</?SYS>>)"
#: Bytes of turns that are assembled at once, and bytes from which on a text is copied in one piece, without an index for its bytes.
SLICE_BYTES = 4 << 20
LONG_BYTES = 1 << 16

FORMATTED = "conv_id long, part long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_TURN = re.compile(re.escape(START.decode()) + r"(.*?)\n(.*?)" + re.escape(END.decode()), re.DOTALL)


def escape(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, CONTROL, r"\1\\\2\3")


def unescape(text: str) -> str:
    return re.sub(ESCAPED, r"\1\2\3", text)


def _role(column: pa.Array) -> pa.Array:
    """Roles on one line: backslashes doubled, line ends as \\n."""
    return escape(pc.replace_substring(pc.replace_substring(column, "\\", "\\\\"), "\n", "\\n"))


def _plain_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the column, and the offsets of its rows."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted turns in one buffer: bytes, offsets of turns, start and end of each text."""
    role, role_at = _bytes(_role(roles))
    text, text_at = _bytes(escape(texts))
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    turn_len = len(START) + role_len + len(BREAK) + text_len + len(END)
    offsets = np.concatenate([[0], np.cumsum(turn_len)])
    role_to = offsets[:-1] + len(START)
    text_to = role_to + role_len + len(BREAK)
    out = np.empty(offsets[-1], np.uint8)
    for fixed, to in ((START, offsets[:-1]), (BREAK, role_to + role_len), (END, text_to + text_len)):
        out[to[:, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
    for source, lengths, at, to in ((role, role_len, role_at, role_to), (text, text_len, text_at, text_to)):
        short = np.flatnonzero(lengths < LONG_BYTES)
        for i in np.flatnonzero(lengths >= LONG_BYTES).tolist():
            out[to[i] : to[i] + lengths[i]] = source[at[i] : at[i + 1]]
        n = lengths[short]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(to[short], n) + inner] = source[np.repeat(at[short], n) + inner]
    return out, offsets, text_to, text_to + text_len


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.binary_length(batch.column(3)).to_numpy().astype(np.int64))
    row = 0
    while row < batch.num_rows:
        done = sizes[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, "right")))
        yield batch.slice(row, end - row)
        row = end


def format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, turn, role, text) -> parts of conversations; a batch ends a part, not a conversation."""
    last, part = object(), 0
    for whole in batches:
        for batch in _slices(whole) if whole.num_rows else ():
            ids = batch.column(0)
            out, offsets, starts, ends = assemble(batch.column(2), batch.column(3))
            numbers, missing = pc.fill_null(ids, 0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            new = np.concatenate([[True], (numbers[1:] != numbers[:-1]) | (missing[1:] != missing[:-1])])
            begin = np.flatnonzero(new)
            bounds = np.concatenate([begin, [batch.num_rows]])
            first = ids[0].as_py()
            parts = np.zeros(len(begin), np.int64)
            parts[0] = part + 1 if first == last and type(first) is type(last) else 0
            last, part = ids[batch.num_rows - 1].as_py(), int(parts[-1])
            loss = pc.equal(batch.column(2), LOSS_ROLE).to_numpy(zero_copy_only=False)
            of = np.searchsorted(begin, np.flatnonzero(loss), "right") - 1
            in_part = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(begin)))]).astype(np.int32)
            base = offsets[begin][of]
            text = pa.Array.from_buffers(
                pa.large_string(), len(begin), [None, pa.py_buffer(offsets[bounds].astype(np.int64)), pa.py_buffer(out)]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(begin)).cast(pa.int64()),
                    pa.array(parts),
                    pa.array(np.diff(bounds)),
                    text.cast(pa.string()),
                    pa.ListArray.from_arrays(pa.array(in_part), pa.array(starts[loss] - base)),
                    pa.ListArray.from_arrays(pa.array(in_part), pa.array(ends[loss] - base)),
                ],
                ["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_ends"],
            )


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, formatted, loss_starts, loss_ends (bytes) of ``turns`` (conv_id, turn, role, text).

    A conversation lies in one partition, its turns ascending (ties by role, then text; NULL turns first); a long one
    comes in several parts, to be joined in order. The loss spans are the texts of assistant turns. A NULL
    text or role is empty, repeated rows are turns of their own, rows with a NULL conv_id are one conversation.
    Rows stream through in batches, so a conversation of any length needs the memory of one batch.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(format_batches, FORMATTED)


class _Digest:
    """What is known of one conversation while its parts are read."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, starts: list[int], ends: list[int]) -> None:
        self.chars += len(formatted)
        for role, text in _TURN.findall(formatted):
            self.n_turns += 1
            self.turns.update(f"{_plain_role(role)}\n{unescape(text)}\n".encode())
        data = formatted.encode()
        for a, b in zip(starts, ends, strict=True):
            text = unescape(data[a:b].decode())
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


def digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of conversations, in order -> one row per conversation, read back from the formatted texts."""
    kind = pa.schema([(n, pa.string() if "sha" in n else pa.int64()) for n in (c.split()[0] for c in DIGESTS.split(", "))])
    current: _Digest | None = None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["part"] == 0:
                if current:
                    done.append(current.row())
                current = _Digest(row["conv_id"])
            current.add(row["formatted"], row["loss_starts"], row["loss_ends"])
        yield pa.RecordBatch.from_pylist(done, kind)
    if current:
        yield pa.RecordBatch.from_pylist([current.row()], kind)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted text says: turns, loss text and their digests, unescaped."""
    return formatted.mapInArrow(digest_batches, DIGESTS)
