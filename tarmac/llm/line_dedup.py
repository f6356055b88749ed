"""Removal of repeated passages by overlapping windows of three lines. DataFrame functions only.

Every run of three consecutive lines is hashed. Of a window that occurs more than once anywhere, the first occurrence
(by document id, then place) stays; lines covered by a later occurrence go, unless it overlaps the first. Windows overlap, so a passage of n lines is
n - 2 repeated windows whose covered positions merge into one cut.

A window travels as its digest with id and place. Counts and first occurrences are combined before the shuffle, so a
window that a third of all documents share costs a few rows per task; finding its later occurrences is a join with one
row per repeated window, which Spark splits where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = 3
_LEAST_ID = -(1 << 63)


def _window_digests(lines: Column) -> Column:
    """Digest of the three lines from each line on; NULL where they are all blank."""

    def digest(i: Column) -> Column:
        run = F.concat_ws("\n", *[F.get(lines, i + k) for k in range(LINES)])
        return F.when(F.trim(F.translate(run, "\n\t\r", "   ")) != "", F.unhex(F.md5(run)))

    return F.transform(F.sequence(F.lit(0), F.size(lines) - LINES), digest)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, spots, text (without the removed lines).

    ``spots`` are the lines (from 0) at which a window begins that occurred before. Lines end at a line feed. Windows
    of blank lines do not count, documents of fewer than three lines have no window. A NULL text stays NULL with 0
    lines. NULL ids come first in the order. Rows that agree in id and text are one document and are not
    removed because of each other; rows with one id and other texts are ordered by a digest of the text.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select(
        F.coalesce("doc_id", F.lit(_LEAST_ID)).alias("id"), F.xxhash64("text").alias("version"), "doc_id", "text"
    )
    lines = F.split("text", "\n", -1)
    # the lines are a column of their own, or every window would split the text again
    windows = (
        base.select("id", "version", lines.alias("lines"))
        .filter(F.size("lines") >= LINES)
        .select("id", "version", F.posexplode(_window_digests(F.col("lines"))).alias("pos", "window"))
        .filter(F.col("window").isNotNull())
    )
    place = F.struct("id", "version", "pos")
    repeated = windows.groupBy("window").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = repeated.filter(F.col("first") != F.col("last")).drop("last")
    # the first occurrence stays whole: one that overlaps it in its own document does not count
    overlaps = (F.col("id") == F.col("first.id")) & (F.col("version") == F.col("first.version")) & (F.col("pos") < F.col("first.pos") + LINES)
    later = windows.join(repeated, "window").filter((place > F.col("first")) & ~overlaps)
    spots = later.groupBy("id", "version").agg(F.sort_array(F.collect_set("pos")).alias("spots"))

    joined = base.join(spots, ["id", "version"], "left").withColumns(
        {
            "lines": F.coalesce(lines, F.array().cast("array<string>")),
            "spots": F.coalesce("spots", F.array().cast("array<int>")),
        }
    )
    n, k = F.size("lines"), F.size("spots")

    def between(i: Column) -> Column:
        """Lines after the spot before and up to spot i."""
        start = F.when(i == 0, F.lit(0)).otherwise(F.get("spots", i - 1) + LINES)
        end = F.when(i == k, n).otherwise(F.get("spots", i))
        return F.slice("lines", F.least(start, n) + 1, F.greatest(end - start, F.lit(0)))

    kept = F.flatten(F.transform(F.sequence(F.lit(0), k), between))
    return joined.withColumn("kept", F.when(k == 0, F.col("lines")).otherwise(kept)).select(
        "doc_id",
        n.cast("long").alias("n_lines"),
        (n - F.size("kept")).cast("long").alias("n_removed"),
        "spots",
        F.when(F.col("text").isNotNull(), F.array_join("kept", "\n")).alias("text"),
    )
