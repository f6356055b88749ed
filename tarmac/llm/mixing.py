"""Mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame functions only.

Every document gets the key -ln(u) / quality, with u in (0, 1) from a digest of its id: the order of the keys is a
weighted draw without replacement that any rerun repeats. Within a source, documents are taken in that order up
to the source's budget of words. A budget above the source's size first takes the whole source as often as it
fits (complete epochs); the rest is the fractional selection.

Prefix sums within a source do not gather it in one task: keys fall into ranges, sums of ranges are added up first,
then each range on its own. Texts are read once; what follows moves a few numbers per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.frames import unused
from tarmac.session import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
#: Key ranges per source; a range of a source with 10^9 documents holds about 10^6.
RANGES = 1024
SEED = "mix"


def quality(words: Column) -> Column:
    """Weight of a document: 0.1 plus the share of its words that are distinct; repetition lowers it."""
    return F.lit(0.1) + F.when(F.size(words) > 0, F.size(F.array_distinct(words)) / F.size(words)).otherwise(0.0)


def sampling_key(doc_id: Column, text: Column, weight: Column, seed: str = SEED) -> Column:
    """An exponential variable with rate ``weight``, the same whenever the document is the same."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return -F.log((number + F.lit(0.5)) / F.lit(float(1 << 52))) / weight


def source_targets(sizes: DataFrame, share: float = 1.0) -> DataFrame:
    """(source, source_size) -> target words of each source, epochs and words of the fractional selection.

    Sources by code point, NULL last, weigh 1, 2, 3 and again. ``share`` of all words is dealt out by weight; a
    target stops at three times its source and the excess goes to the others by weight. One row per source: the
    only window that is not split.
    """
    ranked = sizes.withColumn("i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("i") % len(WEIGHTS) + 1).cast("int"))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = F.col("source_size") * MOST_EPOCHS
    weighed = ranked.select("source", "source_size", "i", weight.cast("long").alias("w"), cap.alias("cap"))
    # the sources that reach their cap are the first by cap / weight
    before = Window.orderBy(F.col("cap") / F.col("w"), "i").rowsBetween(Window.unboundedPreceding, -1)
    total = F.floor(F.sum("source_size").over(everything) * F.lit(share)).cast("long")
    ordered = weighed.select(
        "*",
        (total - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left_words"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("left_weight"),
    )
    capped = F.col("cap") * F.col("left_weight") < F.col("w") * F.col("left_words")
    settled = ordered.withColumn("capped", capped).select(
        "source",
        "source_size",
        "w",
        "cap",
        "capped",
        (total - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything)).alias("open_words"),
        F.sum(F.when(F.col("capped"), 0).otherwise(F.col("w"))).over(everything).alias("open_weight"),
    )
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("w") * F.col("open_words")).cast("double") / F.col("open_weight").cast("double")
    )
    words = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    return (
        settled.select("source", "source_size", target.alias("target"))
        .withColumn("epochs", epochs)
        .withColumn("rest", words - F.col("epochs") * F.col("source_size"))
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    *,
    share: float = 1.0,
    whole: bool = False,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words, repeats counted).

    ``taken`` is the size times the complete epochs, plus what the fractional selection takes: documents in key
    order until the rest of the target is used up. The document on the border is taken in part, so that a source
    meets its target; with ``whole`` it is taken if at least half of it fits. No document is taken more
    than three times. A NULL or empty text has size 0. A NULL source is a source. Rows that agree in id, size and
    source are exchangeable; rows with a NULL id get their key from the text. Without documents: no rows.
    """
    text = F.col(text_col).cast("string")
    words = F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), text.alias("text"), words.alias("words")
    ).select(
        "doc_id",
        "source",
        F.size("words").cast("long").alias("size"),
        sampling_key(F.col("doc_id"), F.col("text"), quality(F.col("words"))).alias("key"),
    )
    place = F.least(F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * RANGES), F.lit(RANGES - 1)).cast("int")
    rows = stored(keyed.withColumn("range", place), "mix")

    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    sources = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sources, share).withColumnRenamed("source", "of")
    in_source = Window.partitionBy("source").orderBy("range")
    ranges = ranges.withColumn("before_range", F.sum("words").over(in_source) - F.col("words"))
    ranges = ranges.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("of"), F.col("range").alias("of_range"), "before_range", "source_size", "target", "epochs", "rest"
    )
    in_range = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("upto", F.sum("size").over(in_range))
    before = F.col("before_range") + F.col("upto") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before))
    if whole:
        part = F.when(part * 2 >= F.col("size"), F.col("size")).otherwise(0)
    return inside.join(
        ranges, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("of_range"))
    ).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("epochs") + part).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix with all their columns, whole, each as often as it is taken.

    Documents of size 0 are in no epoch and left out. Rows with one id are taken as often as the first of them.
    """
    plan = mix(docs, id_col, text_col, source_col, whole=True).filter("taken > 0")
    times, of = unused(docs, "times"), unused(docs, "of")
    plan = plan.groupBy(F.col("doc_id").alias(of)).agg(F.max(F.col("taken") / F.col("size")).cast("int").alias(times))
    joined = docs.join(plan, docs[id_col].eqNullSafe(plan[of])).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return joined.select(*[joined[f"`{c}`"] for c in docs.columns])
