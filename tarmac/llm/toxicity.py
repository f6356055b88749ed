"""Toxicity by compression distance: zstandard dictionaries trained on ordinary and on toxic text.

One dictionary is trained on windows of ordinary documents, one of the same size on windows of toxic documents. How much
shorter or longer the latter makes a window tells phrases that toxic text repeats, also those of ordinary words. Single words
hardly show in it, as a trainer keeps what is frequent. So a third dictionary holds what toxic text adds to the ordinary one:
words and prefixes in more different contexts of toxic documents than ordinary text explains, after the ordinary dictionary, so
that a window compresses better with it only where it uses those words. Contexts, not occurrences, are counted,
so copies of a document count once. Every window of a text is compressed with all three; how often each
difference in length occurs is turned into a probability by weights calibrated on other labelled documents.

Training reads a bounded sample of the labelled rows; every document is scored, over its whole text.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.frames import unused

WINDOW_WORDS = 16
WINDOW_BYTES = 512
LEVEL = 3
#: Bytes of a trained dictionary, and of the words of toxic text.
TRAINED_BYTES = 32_768
WORD_BYTES = 4_096
GAINS = 16
#: Differences between the two trained dictionaries that are told apart, and how many of them are below zero.
LEADS, BEHIND = 32, 8
#: Lengths of prefixes that count like words, so that inflected forms add up.
PREFIXES = (5, 6)
THRESHOLD = 0.3
#: Bound of the training sample: labelled documents of each class, and the characters of a document in it.
SAMPLE = {1: 2_400, 0: 4_800}
LONGEST_SAMPLED = 16_384
#: Bound of the different windows that one dictionary is trained on.
TRAINING_WINDOWS = 100_000


@dataclass
class Model:
    """Three dictionaries, the evidence of each gain by words, and the weights of the features."""

    ordinary: bytes = b" " * 8
    toxic: bytes = b" " * 8  # trained on toxic text
    words: bytes = b" " * 8  # the ordinary one and words of toxic text
    evidence: np.ndarray = field(default_factory=lambda: np.zeros(GAINS))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(6))
    scale: np.ndarray = field(default_factory=lambda: np.ones(6))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(7))

    def score(self, found: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of counted differences."""
        x = (self.features(found) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -30, 30)))

    def features(self, found: np.ndarray) -> np.ndarray:
        gains, leads = found[:, :GAINS], found[:, GAINS:]
        n = gains.sum(axis=1)
        known = gains @ np.maximum(self.evidence, 0)
        tops = [np.where(x > 0, np.arange(x.shape[1]), 0).max(axis=1) for x in (gains, leads)]
        lead = leads @ (np.arange(LEADS) - BEHIND)
        return np.stack([np.log1p(known), known / np.maximum(n, 1), tops[0], np.log1p(n), lead / np.maximum(n, 1), tops[1]], axis=1)


def windows(text: str) -> list[bytes]:
    """The whole text, lower-cased, in runs of words; a run of more than ``WINDOW_BYTES`` is cut."""
    words = text.lower().split()
    out = []
    for i in range(0, len(words), WINDOW_WORDS):
        run = f" {' '.join(words[i : i + WINDOW_WORDS])} ".encode("utf-8", "replace")
        out += [run] if len(run) <= WINDOW_BYTES else [run[j : j + WINDOW_BYTES] for j in range(0, len(run), WINDOW_BYTES)]
    return out


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(LEVEL)
    return zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)


def gain_counter(model: Model):
    """text -> how many of its windows the words make shorter by 0, 1, ... bytes, and how many the toxic dictionary by -8, -7, ..."""
    ordinary, toxic, words = (_compressor(x) for x in (model.ordinary, model.toxic, model.words))

    def count(text: str | None) -> np.ndarray:
        sizes = [(len(ordinary.compress(w)), len(toxic.compress(w)), len(words.compress(w))) for w in windows(text or "")]
        plain, other, added = np.array(sizes, np.int64).reshape(-1, 3).T
        gains = np.bincount(np.clip(plain - added, 0, GAINS - 1), minlength=GAINS)
        return np.concatenate([gains, np.bincount(np.clip(plain - other + BEHIND, 0, LEADS - 1), minlength=LEADS)])

    return count


def _contexts(texts: list[str]) -> tuple[Counter, int]:
    """How many different (word before, word after) each word (with a space behind) and prefix has, and all contexts."""
    numbers: dict[str, int] = {"": 0}
    # numbers of three words in a row, as columns: a set of tuples would take many times the memory
    own = [np.array([numbers.setdefault(w, len(numbers)) for w in text.lower().split()], np.int32) for text in texts]
    code = np.concatenate([np.zeros(0, np.int32), *own])
    ends = np.cumsum([len(x) for x in own if len(x)], dtype=np.int64)
    before, after = np.append(np.int32(0), code[:-1])[: len(code)], np.append(code[1:], np.int32(0))[: len(code)]
    before[ends[:-1]], after[ends - 1] = 0, 0
    order = np.lexsort((after, before, code))
    code, before, after = code[order], before[order], after[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (before[1:] != before[:-1]) | (after[1:] != after[:-1])
    found = np.bincount(code[new], minlength=len(numbers)).tolist()
    counts = Counter({f"{word} ": found[i] for word, i in numbers.items() if found[i]})
    for word, n in list(counts.items()):
        for k in PREFIXES:
            if len(word) > k + 1:
                counts[word[:k]] += n
    return counts, int(new.sum())


def _trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary by zstandard's trainer; of too few samples, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=48, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b" " * 8


def train(rows: list[tuple[int, str, int]]) -> Model:
    """Fit on (rank, text, label) rows. Ranks divisible by 3 calibrate dictionaries trained on the others."""
    labels = np.array([y for _, _, y in rows], float)
    if len(set(labels)) < 2:
        share = min(max(labels.mean() if len(labels) else 0.0, 1e-6), 1 - 1e-6)
        return Model(weights=np.array([math.log(share / (1 - share)), *[0] * 6]))
    held = np.array([rank % 3 == 0 for rank, _, _ in rows])
    if min(len(set(labels[held])), len(set(labels[~held]))) < 2:
        held[:] = True
    model = _dictionaries([r for r, out in zip(rows, held, strict=True) if not out] or rows)
    count = gain_counter(model)
    found = np.array([count(t) for _, t, _ in rows])
    # evidence from documents that did not train the dictionaries
    per_class = [found[held & (labels == y), :GAINS].sum(axis=0) + 0.5 for y in (0, 1)]
    model.evidence = np.log((per_class[1] / per_class[1].sum()) / (per_class[0] / per_class[0].sum()))
    x = model.features(found[held])
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.weights = _logistic(np.column_stack([np.ones(len(x)), (x - model.mean) / model.scale]), labels[held])
    return model


def _dictionaries(rows: list[tuple[int, str, int]]) -> Model:
    """The dictionaries of (rank, text, label) rows."""
    fit = {y: [t for _, t, label in rows if label == y] for y in (0, 1)}
    toxic, n_toxic = _contexts(fit[1])
    plain, n_plain = _contexts(fit[0])
    least = max(3, math.ceil(0.008 * len(fit[1])))
    ratio = n_toxic / max(n_plain, 1)
    chosen = []
    for w, n in toxic.items():
        # there are more prefixes than words that look toxic by chance
        count, odds = (least, 20) if w.endswith(" ") else (2 * least, 100)
        if n >= count and n >= odds * ratio * (plain[w] + 1):
            chosen.append(w)
    chosen.sort(key=lambda w: (toxic[w], w))
    trained = []
    for y in (0, 1):
        samples = sorted({w for t in fit[y] for w in windows(t)})
        random.Random(5).shuffle(samples)
        trained.append(_trained(samples[:TRAINING_WINDOWS], TRAINED_BYTES))
    added = b"".join(f" {w}".encode("utf-8", "replace") for w in chosen)[-WORD_BYTES:]
    # the compressor's table keeps what comes last
    return Model(*trained, trained[0] + added)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; all but the first are shrunk a little."""
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6, *[penalty] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
    return w


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, str, int]]:
    """A bounded sample of labelled documents: at most ``SAMPLE`` ids of each class, by a digest of the id.

    A document with several labels is toxic if one says so; NULL labels and ids do not count.
    Documents of more than ``LONGEST_SAMPLED`` characters are not used for training; of several rows with one id, one text is. Only the chosen ids, a
    bounded number, are broadcast to find their texts.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("of")).agg(F.max("toxic").alias("toxic"))
    digest = F.md5(F.col("of").cast("string"))
    picks = [
        known.filter(F.col("toxic") == y).orderBy(digest, "of").limit(n).select("of", "toxic") for y, n in SAMPLE.items()
    ]
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = texts.filter(F.length("text") <= LONGEST_SAMPLED).join(
        F.broadcast(picks[0].unionByName(picks[1])), F.col("doc_id") == F.col("of")
    )
    # one text of an id, however many rows it has
    one = found.groupBy("of", "toxic").agg(F.min("text").alias("text"))
    rows = one.select(F.md5(F.col("of").cast("string")).alias("digest"), "text", "toxic").collect()
    return [(i, r.text, int(r.toxic)) for i, r in enumerate(sorted(rows))]


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """The documents with all their columns and the probability that each is toxic.

    Every window of the whole text counts, nothing but the text does. A NULL or empty text has no window and
    gets the probability that goes with it. A ``name`` that is a column already is refused. No shuffle.
    """
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the documents already have a column {name}; choose another name")
    at = docs.columns.index(text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = gain_counter(model)
        for batch in batches:
            if batch.num_rows:
                gains = np.array([count(t.as_py()) for t in batch.column(at)])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(model.score(gains), pa.float64())], [*batch.schema.names, name]
                )

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(apply, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, with their columns, that score below the threshold."""
    name = unused(docs, "score")
    scored = score(docs, train(training_rows(docs, labels, text_col=text_col)), text_col, name)
    return scored.filter(F.col(name) < THRESHOLD).drop(name)
