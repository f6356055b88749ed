"""Datasets known under several names: classes of names from pairs that mean the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tarmac.session import discard, stored

#: A class table is only hinted for broadcast after its rows were counted and found to be at most this many.
BROADCAST_ROWS = 100_000


def alias_classes(pairs: DataFrame) -> DataFrame:
    """(dataset, class) for all names in the pairs (name, alias); the class is its least name.

    Names that are tied over any number of pairs are one class. Every round, a name takes the least class among its
    neighbours, then the class of that class, so rounds grow slowly with the length of a chain. Rounds are
    stored in the shared folder. Rows with a NULL side are left out; a pair of equal names makes a class of its own.
    """
    ends = F.array(F.struct("name", "alias"), F.struct(F.col("alias").alias("name"), F.col("name").alias("alias")))
    known = pairs.filter("name IS NOT NULL AND alias IS NOT NULL")
    links = stored(known.select(F.inline(ends)).distinct(), "links")
    labels = stored(links.groupBy("name").agg(F.least("name", F.min("alias")).alias("class")), "classes")
    while True:
        near = links.join(labels.select(F.col("name").alias("alias"), "class"), "alias").groupBy("name").agg(F.min("class").alias("class"))
        # the class of the class: a class is always a name
        of_class = labels.select(F.col("name").alias("class"), F.col("class").alias("further"))
        moved = near.join(of_class, "class").select("name", F.least("class", "further").alias("new"))
        seen = Observation()
        following = moved.join(labels, "name").select("name", F.least("new", "class").alias("class"), "class")
        following = following.toDF("name", "class", "before").observe(seen, F.count(F.when(F.col("class") != F.col("before"), 1)).alias("n"))
        following = stored(following, "classes")
        discard(labels)
        labels = following.drop("before")
        labels.scratch_place = following.scratch_place
        if not seen.get["n"]:
            discard(links)
            return labels.withColumnRenamed("name", "dataset")


def in_classes(frame: DataFrame, columns: list[str], classes: DataFrame) -> DataFrame:
    """The frame with the names in some columns replaced by their classes; names without one stay.

    The class table may have any size: it is broadcast when it was counted to be small, else joined by a shuffle.
    """
    small = classes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    for column in columns:
        of = classes.select(F.col("dataset").alias("known_name"), F.col("class").alias("known_class"))
        joined = frame.join(F.broadcast(of) if small else of, F.col(column) == F.col("known_name"), "left")
        frame = joined.withColumn(column, F.coalesce("known_class", column)).drop("known_name", "known_class")
    return frame
