"""From detections to clips: plan, snap to keyframes, removed spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverlog.operators import intervals
from riverlog.operators.joins import asof


def snap(keep: DataFrame, keyframes: DataFrame, by: list[str], topic: str, min_keep: int = 0) -> DataFrame:
    """Moves each kept start to a place where all topics can start.

    First to the latest of the topics' next keyframes (a topic without one gives the span's end), then back to the earliest
    of the topics' keyframes at or before it, unless that lies before the span. Spans shorter than min_keep then go.
    """
    topics = keyframes.select(*by, topic).distinct()
    each = keep.join(topics, by)
    on = [*by, topic]
    keys = keyframes.select(*on, "t").withColumn("k", F.col("t"))
    ahead = asof(each.withColumn("t", F.col("a")), keys, on, "t", "k", "next", forward=True)
    nxt = ahead.groupBy(*by, "a", "b").agg(F.max(F.coalesce("next", "b")).alias("nxt"), F.count_if(F.col("next").isNull()).alias("topics_without"))
    # Dealt anew, so that the second half's sorts are not held beside those of the first.
    back = asof(nxt.repartition(*by).join(topics, by).withColumn("t", F.col("nxt")), keys, on, "t", "k", "prev")
    first = back.groupBy(*by, "a", "b", "nxt", "topics_without").agg(F.min(F.coalesce("prev", F.lit(0))).alias("low"))
    start = F.when(F.col("low") < F.col("a"), F.col("nxt")).otherwise(F.col("low"))
    return first.select(*by, start.alias("a"), "b", "topics_without").where((F.col("b") - F.col("a") >= min_keep) & (F.col("b") > F.col("a")))


def removed(clips: DataFrame, bounds: DataFrame, keyframes: DataFrame, by: list[str], topic: str, min_removed: int = 0) -> DataFrame:
    """The spans between clips, begun at the earliest of the topics' last keyframes before them, so that they can be played."""
    out = intervals.gaps(clips, bounds, by).where(F.col("b") - F.col("a") >= min_removed)
    each = out.join(keyframes.select(*by, topic).distinct(), by).withColumn("t", F.col("a"))
    back = asof(each, keyframes.select(*by, topic, "t").withColumn("k", F.col("t")), [*by, topic], "t", "k", "prev")
    return back.groupBy(*by, F.col("t").alias("gap_a"), "b").agg(F.min(F.coalesce("prev", F.lit(0))).alias("a")).select(*by, "a", "b")


def targets(clips: DataFrame, gone: DataFrame, by: list[str], stem: str) -> DataFrame:
    """One list of outputs with names {stem}_clip00, {stem}_removed00."""
    from pyspark.sql import Window

    both = clips.select(*by, "a", "b").withColumn("kind", F.lit("clip")).unionByName(gone.select(*by, "a", "b").withColumn("kind", F.lit("removed")))
    k = F.row_number().over(Window.partitionBy(*by, "kind").orderBy("a", "b")) - 1
    return both.withColumn("name", F.format_string("%s_%s%02d", F.col(stem).cast("string"), F.col("kind"), k))
