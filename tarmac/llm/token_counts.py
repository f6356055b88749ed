"""Token counts by source, language and tokenizer version, kept up to date by signed changes.

A batch says what is known of documents from now on: an ``upsert`` gives a document's count under a
tokenizer version, a ``delete`` takes it away. Against the last known state each batch becomes signed sums per
group: plus the new count, minus the old one. Totals are sums of these, so no batch reads the documents
again. The state is a log: each batch adds the rows it changed, the last row of a document and version is valid.

A batch is prepared in a folder of its own and committed by one rename. A batch id that is there already is
skipped, an attempt that died leaves nothing that counts: each batch counts once, however often it is sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.words import chunks
from tarmac.session import remove_path, scratch_path

#: Counting rules that need no vocabulary: words, and letters, up to three digits or single other characters.
PATTERNS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "pieces-1": r"\p{L}+|\p{N}{1,3}|[^\x20\x09-\x0D\p{L}\p{N}]",
}

KEY = ["doc_id", "version"]
GROUP = ["source", "lang", "version"]
_LOG = "doc_id long, version string, source string, lang string, n_tokens long, live boolean, seq long"
_DELTA = "source string, lang string, version string, n_docs long, n_tokens long"


def pattern_counts(text: Column) -> Column:
    """An array of (version, n_tokens), one for each counting rule; NULL text counts 0."""
    counts = [
        F.struct(F.lit(version).alias("version"), F.coalesce(F.regexp_count(text, F.lit(p)), F.lit(0)).cast("long").alias("n_tokens"))
        for version, p in PATTERNS.items()
    ]
    return F.array(*counts)


def encoded_counts(docs: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """(doc_id, source, lang, version, n_tokens) with the ids of a vocabulary file that the token files can use as well."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tarmac.llm.token_files import ENCODE_BYTES, encoder

        for batch in batches:
            for first, _, offsets in chunks(batch.column(3), ENCODE_BYTES):
                own = batch.slice(first, len(offsets) - 1)
                _, n = encoder(tokenizer).encode(own.column(3))
                names = ["doc_id", "source", "lang", "version", "n_tokens"]
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[:3], pa.array([version] * len(n)), pa.array(n, pa.int64())], names
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(apply, "doc_id long, source string, lang string, version string, n_tokens long")


class TokenRollup:
    """Token totals in a folder of the shared file system. One writer at a time.

    ``commit`` takes rows (doc_id, source, lang, version, n_tokens, op, order): ``op`` is upsert or delete, of
    several rows for a document and version the last by ``order`` counts, ties go to the larger count. An
    upsert of a known document replaces it, also its source and language; deletes of unknown documents do
    nothing. NULL source, language or version are groups (an empty version counts as NULL). A NULL count is 0. Upserts with a NULL id are counted, cannot be
    revised and their deletes are ignored. An empty batch is committed as well.
    """

    def __init__(self, spark: SparkSession, place: str):
        self.spark, self.place = spark, place.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.place).getFileSystem(spark._jsc.hadoopConfiguration())

    def _batches(self) -> list[str]:
        """Names of the committed batches."""
        log = self._path(f"{self.place}/log")
        return [s.getPath().getName() for s in self._files.listStatus(log)] if self._files.exists(log) else []

    def _read(self, what: str, schema: str) -> DataFrame:
        folders = [f"{self.place}/log/{b}/{what}" for b in self._batches()]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def commit(self, batch_id: str, rows: DataFrame) -> bool:
        """Apply a batch; False if it was committed before."""
        done = self._batches()
        if batch_id in done:
            return False
        amount = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0))
        given = rows.select(*KEY, "source", "lang", amount.alias("n_tokens"), (F.col("op") == "upsert").alias("live"), "order")
        value = F.struct("order", "n_tokens", "live", "source", "lang")
        known = given.filter("doc_id IS NOT NULL").withColumn("version", F.coalesce("version", F.lit("")))
        last = known.groupBy(*KEY).agg(F.max(value).alias("new")).select(*KEY, "new.*").drop("order")
        staged = f"{self.place}/staged/{scratch_path(self.spark, 'batch').rsplit('/', 1)[1]}"
        last.withColumn("seq", F.lit(len(done)).cast("long")).write.parquet(f"{staged}/log")
        new = self.spark.read.schema(_LOG).parquet(f"{staged}/log")

        state = F.struct("seq", "live", "n_tokens", "source", "lang")
        before = self._read("log", _LOG).join(new.select(*KEY), KEY, "left_semi")
        before = before.groupBy(*KEY).agg(F.max(state).alias("old")).select(*KEY, "old.*")
        named = F.when(F.col("version") != "", F.col("version")).alias("version")

        def signed(frame: DataFrame, sign: int) -> DataFrame:
            return frame.filter("live").select(
                "source", "lang", named, F.lit(sign).cast("long").alias("n_docs"), (F.col("n_tokens") * sign).alias("n_tokens")
            )

        changes = signed(new, 1).unionByName(signed(before, -1)).unionByName(signed(given.filter("doc_id IS NULL"), 1))
        sums = changes.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        sums.filter("n_docs != 0 OR n_tokens != 0").write.parquet(f"{staged}/delta")
        self._files.mkdirs(self._path(f"{self.place}/log"))
        if not self._files.rename(self._path(staged), self._path(f"{self.place}/log/{batch_id}")):
            raise RuntimeError(f"batch {batch_id} could not be committed")
        return True

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens; groups without documents are left out."""
        sums = self._read("delta", _DELTA).groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs != 0 OR n_tokens != 0")

    def remove(self) -> None:
        """Delete the folder."""
        remove_path(self.spark, self.place)
