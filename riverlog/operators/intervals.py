"""Interval algebra over recordings. Bounds are inclusive and integers (micro- or nanoseconds); every window is partitioned by `by`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _groups(df: DataFrame, by: list[str], order: list[str], breaks: Column) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_new", breaks.cast("int")).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def sessions(df: DataFrame, by: list[str], t: str = "t", gap: int = 0, hold: int = 0) -> DataFrame:
    """Times further than `gap` from the one before start a new session [first, last + hold]; hold does not join sessions."""
    last = F.lag(t).over(Window.partitionBy(*by).orderBy(t))
    grouped = _groups(df, by, [t], last.isNull() | (F.col(t) - last > gap))
    return grouped.groupBy(*by, "_g").agg(F.min(t).alias("a"), (F.max(t) + hold).alias("b"), F.count("*").alias("n")).drop("_g")


def pad(df: DataFrame, by_start: int | Column, width: int) -> DataFrame:
    """[max(start, a - width), b + width]; the end is not cut."""
    start = by_start if isinstance(by_start, Column) else F.lit(by_start)
    return df.withColumn("a", F.greatest(start, F.col("a") - width)).withColumn("b", F.col("b") + width)


def union(df: DataFrame, by: list[str], gap: int = 0) -> DataFrame:
    """Spans no further than `gap` apart become one."""
    w = Window.partitionBy(*by).orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("b").over(w)
    grouped = _groups(df.withColumn("_reach", reach), by, ["a", "b"], F.col("_reach").isNull() | (F.col("a") - F.col("_reach") > gap))
    return grouped.groupBy(*by, "_g").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("_g")


def complement(drops: DataFrame, bounds: DataFrame, by: list[str], min_keep: int = 0) -> DataFrame:
    """What disjoint drops leave of [0, duration], runs of min_keep or more. Recordings of `bounds`(by, duration) without drops stay whole."""
    none = F.lit(None).cast("long")
    ends = bounds.select(*by, F.col("duration").cast("long").alias("a"), none.alias("b"), F.lit(1).alias("_end"))
    # A recording's end stands behind all its drops: one window, in which no row meets another one by a join.
    cursor = F.max("b").over(Window.partitionBy(*by).orderBy("_end", "a").rowsBetween(Window.unboundedPreceding, -1))
    runs = drops.select(*by, F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), F.lit(0).alias("_end")).unionByName(ends)
    return runs.select(*by, F.greatest(F.coalesce(cursor, F.lit(0)), F.lit(0)).alias("s"), F.col("a").alias("e")).where(F.col("e") - F.col("s") >= min_keep).select(*by, F.col("s").alias("a"), F.col("e").alias("b"))


def gaps(keep: DataFrame, bounds: DataFrame, by: list[str]) -> DataFrame:
    """What lies between kept spans, of any length above 0."""
    return complement(keep, bounds, by, 1)


def plan_summary(keep: DataFrame, bounds: DataFrame, by: list[str]) -> DataFrame:
    """Per recording of `bounds`, one row each: segments, kept, removed, longest, the upper median run, kept_ppm (parts of a million)."""
    runs = keep.select(*by, F.lit(None).cast("long").alias("duration"), (F.col("b") - F.col("a")).alias("_run"), F.lit(False).alias("_whole"))
    both = runs.unionByName(bounds.select(*by, F.col("duration").cast("long").alias("duration"), F.lit(None).cast("long").alias("_run"), F.lit(True).alias("_whole")))
    median = F.element_at(F.array_sort(F.collect_list("_run")), (F.count("_run") / 2).cast("int") + 1)
    got = both.groupBy(*by).agg(F.max("duration").alias("duration"), F.max("_whole").alias("_whole"), F.count("_run").alias("segments"), F.sum("_run").alias("kept"), F.max("_run").alias("longest"), F.when(F.count("_run") > 0, median).alias("median"))
    full = got.where("_whole").drop("_whole").na.fill(0, ["segments", "kept", "longest", "median"])
    return full.withColumn("removed", F.col("duration") - F.col("kept")).withColumn("kept_ppm", F.when(F.col("duration") > 0, F.floor(F.col("kept") * 1_000_000 / F.col("duration"))).otherwise(0).cast("long"))


def sweep(drops: DataFrame, bounds: DataFrame, by: list[str], values: list[int]) -> DataFrame:
    """plan_summary for each min_keep: runs are made once and replicated for the few values."""
    each = F.explode(F.array(*[F.lit(v).cast("long") for v in values]))
    runs = complement(drops, bounds, by).withColumn("min_keep", each).where(F.col("b") - F.col("a") >= F.col("min_keep"))
    return plan_summary(runs, bounds.withColumn("min_keep", each), [*by, "min_keep"])
