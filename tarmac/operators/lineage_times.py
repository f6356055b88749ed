"""When datasets were read without a valid version of them: gaps over time, by a sweep."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tarmac.functions.time import parse_instant

#: Points in time of a dataset are added up in blocks of this many seconds first, then inside each block.
BLOCK_SECONDS = 86_400


def dataset_uses(events: DataFrame, dataset: Callable[[Column, Column], Column], read_for: str, valid_for: str) -> DataFrame:
    """(dataset, kind, valid_from, valid_to): when datasets are wanted and when they are there.

    A run wants its inputs for ``read_for`` from its START on; a COMPLETE makes its outputs valid for ``valid_for``. Both
    are SQL intervals. ``dataset`` makes the name of a dataset from its address and name.
    """
    at = parse_instant(F.col("eventTime"))
    sides = events.select(
        at.alias("valid_from"),
        F.when(F.col("eventType") == "START", F.lit("read")).when(F.col("eventType") == "COMPLETE", F.lit("write")).alias("kind"),
        F.when(F.col("eventType") == "START", F.arrays_zip("inputs.namespace", "inputs.name"))
        .when(F.col("eventType") == "COMPLETE", F.arrays_zip("outputs.namespace", "outputs.name"))
        .alias("named"),
    )
    named = sides.select("valid_from", "kind", F.inline("named"))
    lasts = F.when(F.col("kind") == "read", F.expr(f"INTERVAL {read_for}")).otherwise(F.expr(f"INTERVAL {valid_for}"))
    return named.select(dataset(F.col("namespace"), F.col("name")).alias("dataset"), "kind", "valid_from", (F.col("valid_from") + lasts).alias("valid_to"))


def gaps_over_time(uses: DataFrame) -> DataFrame:
    """(dataset, gap_from, gap_to): the longest stretches in which a dataset is wanted and not there.

    ``uses`` holds half-open intervals [valid_from, valid_to) of the kinds ``read`` and ``write``. Every interval opens at one
    point and closes at another; running sums over the points of a dataset tell how many reads and writes are open. No
    interval is compared with another. Points are added up per dataset and time first, then over blocks of time, then
    inside each block, so that a dataset with a third of all events is spread over its blocks. Points are shuffled once. Empty intervals and
    rows without dataset or times are left out.
    """
    proper = uses.filter("dataset IS NOT NULL AND valid_from < valid_to")
    is_read = F.col("kind") == "read"

    def point(at: str, step: int) -> Column:
        return F.struct(
            F.col(at).alias("at"),
            F.when(is_read, step).otherwise(0).alias("reads"),
            F.when(is_read, 0).otherwise(step).alias("writes"),
        )

    points = proper.select("dataset", F.inline(F.array(point("valid_from", 1), point("valid_to", -1)))).withColumn("block", _block("at"))
    sums = [F.sum(c).alias(c) for c in ("reads", "writes")]
    # dealt out once by dataset and block: all that follows in a block finds its rows there
    per_time = points.filter("block IS NOT NULL").repartition("dataset", "block").groupBy("dataset", "block", "at").agg(*sums)
    in_block, running = _in_block(), _in_block().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("dataset").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = per_time.groupBy("dataset", "block").agg(*sums)
    bases = blocks.select("dataset", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("reads", "writes")])
    lacking = F.expr("reads > 0 AND writes = 0")
    states = (
        per_time.join(bases, ["dataset", "block"])
        .withColumns({c: F.col(f"{c}_before") + F.sum(c).over(running) for c in ("reads", "writes")})
        .select("dataset", "block", "at", lacking.alias("lacking"), F.expr("reads_before > 0 AND writes_before = 0").alias("lacking_before"))
    )
    # what is open before a block is the state of the point before its first one
    before = F.coalesce(F.lag("lacking").over(in_block), F.col("lacking_before"))
    changes = states.withColumn("before", before).filter("lacking <> before").drop("before", "lacking_before")
    # beginnings and ends alternate; most meet in their block, at most two of a block do not: its first end and its last beginning
    paired = changes.withColumns({"gap_to": F.lead("at").over(in_block), "is_first": F.lag("at").over(in_block).isNull()})
    kept = paired.filter("lacking OR is_first").withColumn("met_in", F.when(F.col("lacking") & F.col("gap_to").isNotNull(), F.col("block")))
    later = F.lead("at").over(Window.partitionBy("dataset", "met_in").orderBy("at"))
    gaps = kept.withColumn("gap_to", F.when(F.col("met_in").isNotNull(), F.col("gap_to")).otherwise(later))
    return gaps.filter("lacking").select("dataset", F.col("at").alias("gap_from"), "gap_to")


def _block(at: str) -> Column:
    return F.floor(F.unix_micros(F.col(at).cast("timestamp")) / F.lit(BLOCK_SECONDS * 1_000_000))


def _in_block() -> WindowSpec:
    return Window.partitionBy("dataset", "block").orderBy("at")
